"""Documents for the tests of the training-data operators."""

import random

import pytest

WORDS = "a b c dé é x y the of".split()


def make_docs(seed, sep=" ", size=40):
    """(doc_id, text): nulls, empties, repeated rows, shared passages, hot copies."""
    r = random.Random(seed)
    base = [" ".join(r.choice(WORDS) for _ in range(90)) for _ in range(4)]
    docs = [(0, None), (1, ""), (2, "x"), (None, base[0]), (None, None), (3, "a " * 150)]
    for i in range(4, size):
        parts = []
        for _ in range(r.randint(1, 4)):
            b, kind = r.choice(base), r.random()
            if kind < 0.5:
                s = r.randint(0, len(b))
                parts.append(b[s:s + r.randint(1, 90)])
            elif kind < 0.7:
                parts.append("".join(r.choice("abé \n") for _ in range(r.randint(0, 60))))
            else:
                parts.append(b)
        docs.append((i, sep.join(parts)))
    docs += [docs[10], (99, docs[11][1]), (12, docs[13][1]), *((100 + i, base[1]) for i in range(8))]
    r.shuffle(docs)
    return docs


def frame(spark, docs, extra=True):
    """A table of documents with further columns, some named like internal ones."""
    rows = [(d, t, "k", i, "s", None) for i, (d, t) in enumerate(docs)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, `key` string, tid int, spans string, n_words long")
    return (df if extra else df.select("doc_id", "text")).repartition(3)


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package sent to its Python workers."""
    from tillroll.llm.common import ship

    ship(spark)
    return spark
