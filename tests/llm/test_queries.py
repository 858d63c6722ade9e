"""The registered queries and the pipeline on the small tables."""

import hashlib
import re

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from llm_helpers import frame, llm, make_docs  # noqa: F401
from test_dedup import fingerprint, grouped, removed_bytes, removed_words
from test_rules import plain_signals
from test_text import edit_search
from tillroll.llm import decontaminate, queries

COLUMNS = {
    "op1_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op3_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                          "n_repeat_words", "base_failed", "kept"],
    "op5_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op6_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op7_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op8_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op9_benchmark_decontamination": ["doc_id", "item_id", "distance", "budget"],
    "op10_byte_level_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_source_divergence": ["lang", "source", "part", "item", "value", "rank"],
    "op12_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op13_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                                 "cost", "audit", "repaired_sha256"],
}


def table(name):
    return pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def results(llm):
    return {n: entry.queries()[n](llm, SF_SMALL).collect() for n in COLUMNS}


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(results, name):
    rows = results[name]
    assert set(COLUMNS[name]) <= set(rows[0].__fields__)
    of = {"doc_id": "documents", "page_id": "pages", "vec_id": "embeddings"}.get(COLUMNS[name][0])
    if of and "op9" not in name:
        assert len(rows) == len(table(of))


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert {"pipeline", *COLUMNS} <= set(entry.queries())


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_oracle(results, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(results[name][0].__fields__)
    assert sorted(cur.fetchall(), key=repr) == sorted(
        (tuple(r[n] for n in names) for r in results[name]), key=repr)


def test_op1_and_op7_against_brute_force(results):
    docs = [(r["doc_id"], r["text"]) for r in table("documents")]
    assert {tuple(r) for r in results["op1_suffix_array_dedup"]} == {
        (d, n, m, s, sha(k)) for d, n, m, s, k in removed_bytes(docs, 200)}
    assert {tuple(r) for r in results["op7_substring_dedup"]} == {
        (d, n, m, sha(k.encode())) for d, n, m, k in removed_words(docs, 50)}


def test_op4_base_against_brute_force(results):
    got = {r.doc_id: r for r in results["op4_quality_rules"]}
    for d in table("documents")[:60]:
        if len(d["text"]) < 3000:
            r = got[d["doc_id"]]
            assert plain_signals(d["text"], 10) == (
                r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.covered_words, r.longest_repeat)


def test_op6_against_brute_force(results):
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in table("documents")}
    close = grouped(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for d in sorted(prints):
        first.setdefault(close[prints[d]], d)
    assert {tuple(r) for r in results["op6_simhash_near_dedup"]} == {
        (d, f"{f:016x}", first[close[f]]) for d, f in prints.items()}


def test_op8_takes_the_article(results):
    pages = {p["page_id"]: p["html"] for p in table("pages")}
    for r in results["op8_html_extraction"]:
        assert r.n_chars == len(r.text) > 0
        body = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        import html
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", body)).split())


def test_op9_finds_all_whole_items(results):
    got = {(r.doc_id, r.item_id) for r in results["op9_benchmark_decontamination"]}
    for d in table("documents"):
        text = decontaminate.normalize(d["text"])
        for item in table("benchmark"):
            if decontaminate.normalize(item["text"]) in text:
                assert (d["doc_id"], item["item_id"]) in got


def test_op3_learns(results):
    held = [r for r in results["op3_lm_scoring"] if r.held_out]
    assert held and sum(r.score for r in held) < 0
    assert sum(r.score for r in held) > 1.13 * sum(r.base_score for r in held)  # 1.116 when measured


def test_pipeline_against_brute_force(llm, tmp_path):
    """Every stage on documents with copies, junk, shared passages and items."""
    import random

    import public_tokenizers
    import tiktoken

    r = random.Random(9)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"] + ["é"]
    def prose(n):
        return " ".join(r.choice(vocabulary) + r.choice(vocabulary) for _ in range(n))

    shared, item = prose(80), prose(30)
    docs = [(i, prose(r.randint(60, 200))) for i in range(20)]
    docs += [(20, docs[3][1]), (21, docs[3][1]), (22, "too short"), (23, "a b " * 100), (24, None),
             (25, prose(70) + " " + shared), (26, shared + " " + prose(90)), (27, prose(60) + " " + item)]
    frame(llm, docs).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    held = []
    for d, t in docs:
        s = plain_signals(t, 10)
        if s[0] >= 50 and 100 * s[4] <= 50 * s[0] and 100 * s[5] <= 30 * s[0] and (
                s[6] < 10 or 100 * s[6] <= 20 * s[0]):
            held.append((d, t))
    close = grouped({fingerprint(t) for _, t in held}, lambda a, b: (a ^ b).bit_count() <= 3)
    seen, one = set(), []
    for d, t in sorted(held):
        if close[fingerprint(t)] not in seen:
            seen.add(close[fingerprint(t)])
            one.append((d, t))
    left = [(d, k.decode()) for d, _, _, _, k in removed_bytes(one, 200)]
    search = decontaminate.normalize(item)
    clean = [(d, t) for d, t in left if edit_search(search, decontaminate.normalize(t))
             > decontaminate.budget(search, 0.08)]
    ranks = queries.bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for d, t in clean:
        ids = own.encode_ordinary(t)
        want.add((d, len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode())))
    assert 10 < len(want) < len(docs) - 5
    got = corpus_pipeline.run(llm, str(tmp_path)).collect()
    assert len(got) == len(want)
    assert {(x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in got} == want
    left = dict(clean)
    for x in got:
        assert x.text == left[x.doc_id] and own.decode(x.ids) == x.text and x["key"] == "k"


def test_stages_keep_the_columns(llm):
    df = frame(llm, make_docs(10))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, df, SF_SMALL)
        assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
