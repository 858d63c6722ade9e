"""DuckDB SQL for the SimHash query, with XXH64 spelt out in integer arithmetic."""

from __future__ import annotations

# XXH64 (fixed values: its primes) in 128-bit arithmetic: a product of two words
# fits, and a word written twice in a row turns by a shift.
_P1, _P2, _P3, _P4, _P5 = (f"{p}::UHUGEINT" for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161,
    9650029242287828579, 2870177450012600261))


def _low(x: str) -> str:
    return f"(({x}) & 18446744073709551615::UHUGEINT)"


def _turn(x: str, by: int) -> str:
    return _low(f"(({x}) * 18446744073709551617::UHUGEINT) >> {64 - by}")


def _round(acc: str, lane: str) -> str:
    return _low(_turn(f"{_low(f'{acc} + {_low(f'{lane} * {_P2}')}')}", 31) + f" * {_P1}")


def _number(at: str, size: int) -> str:
    """The little-endian number of ``size`` bytes from byte ``at`` of the hex string e."""
    pairs = " || ".join(f"e[2 * ({at}) + {2 * i + 1}:2 * ({at}) + {2 * i + 2}]" for i in reversed(range(size)))
    return f"('0x' || {pairs})::UBIGINT::UHUGEINT"


def _stripe(j: int, start: str) -> str:
    return (f"list_reduce(list_prepend({_low(start)}, list_transform("
            f"generate_series({j}, n // 32 * 4 - 1, 4), lambda i: lanes[i + 1])), "
            f"lambda acc, x: {_round('acc', 'x')}) AS v{j}")


def _joined(h: str, v: str) -> str:
    return _low(f"{_low(f'xor({h}, {_round('0::UHUGEINT', v)}) * {_P1}')} + {_P4}")


_STRIPES = ", ".join([
    _stripe(0, f"42::UHUGEINT + {_P1} + {_P2}"), _stripe(1, f"42::UHUGEINT + {_P2}"),
    _stripe(2, "42::UHUGEINT"), _stripe(3, f"18446744073709551658::UHUGEINT - {_P1}")])
_SUMMED = _low(" + ".join(_turn(f"v{j}", by) for j, by in enumerate((1, 7, 12, 18))))
_MERGED = _joined(_joined(_joined(_joined("t", "v0"), "v1"), "v2"), "v3")
_EIGHT = _low(_low(_turn(f"xor(h, {_round('0::UHUGEINT', 'x')})", 27) + f" * {_P1}") + f" + {_P4}")
_FOUR = _low(_low(_turn(f"xor(h, {_low(f'{_number('n // 8 * 8', 4)} * {_P1}')})", 23) + f" * {_P2}") + f" + {_P3}")
_ONE = _low(_turn(f"xor(h, {_low(f'x * {_P5}')})", 11) + f" * {_P1}")

#: The hashes of the strings x of ``term``.
_XXH64 = f"""
cut AS (
  SELECT x, e, n, list_transform(generate_series(0, n // 8 - 1), lambda i: {_number('8 * i', 8)}) AS lanes,
         list_transform(generate_series(n // 4 * 4, n - 1), lambda i: {_number('i', 1)}) AS bytes
  FROM (SELECT x, hex(encode(x)) AS e, len(hex(encode(x))) // 2 AS n FROM term)),
striped AS (SELECT *, {_STRIPES} FROM cut),
summed AS (SELECT *, {_SUMMED} AS t FROM striped),
begun AS (
  SELECT *, {_low(f"n::UHUGEINT + CASE WHEN n >= 32 THEN {_MERGED} ELSE 42::UHUGEINT + {_P5} END")} AS h FROM summed),
eights AS (
  SELECT * REPLACE (list_reduce(list_prepend(h, lanes[n // 32 * 4 + 1:]), lambda h, x: {_EIGHT}) AS h) FROM begun),
fours AS (SELECT * REPLACE (CASE WHEN n % 8 >= 4 THEN {_FOUR} ELSE h END AS h) FROM eights),
ones AS (SELECT x, list_reduce(list_prepend(h, bytes), lambda h, x: {_ONE}) AS h FROM fours),
mixed AS (SELECT x, {_low(f"xor(h, h >> 33) * {_P2}")} AS h FROM ones),
again AS (SELECT x, {_low(f"xor(h, h >> 29) * {_P3}")} AS h FROM mixed),
hashed AS (SELECT x, xor(h, h >> 32)::UBIGINT AS h FROM again)"""

_BITS = " + ".join(
    f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(*) THEN {1 << b}::UHUGEINT ELSE 0 END" for b in range(64))

SIMHASH_NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingle AS (
  SELECT rid, array_to_string(words[s:s + 2], ' ') AS x
  FROM (SELECT rid, words, unnest(generate_series(1, greatest(1, len(words) - 2))) AS s FROM w WHERE len(words) > 0)),
term AS (SELECT DISTINCT x FROM shingle),{_XXH64},
print AS (SELECT rid, ({_BITS})::UBIGINT AS fp FROM shingle JOIN hashed USING (x) GROUP BY rid),
f AS (SELECT doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM w LEFT JOIN print USING (rid)),
node AS (SELECT fp, min(doc_id) AS least FROM f GROUP BY fp),
link AS (
  SELECT a.fp AS u, b.fp AS v FROM node a JOIN node b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)::UHUGEINT::BIT) <= 3),
reach AS (
  SELECT fp AS u, fp AS v FROM node
  UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
part AS (SELECT u AS fp, min(least) AS component_id FROM reach JOIN node ON node.fp = reach.v GROUP BY u)
SELECT doc_id, lpad(lower(hex(fp)), 16, '0') AS fingerprint, component_id FROM f JOIN part USING (fp)
"""
