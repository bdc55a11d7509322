"""Secret scan: fixed patterns, and windows of high Shannon entropy over candidate strings.

A candidate is a run of 20 or more of `[A-Za-z0-9+/_=-]`. A window of 20 characters slides over it; the character
counts and the sum of c*log2(c) change by one entering and one leaving character, which gives each window's entropy.
The largest is compared with the threshold of the candidate's class: hexadecimal digits, or any of the 65.
The allow list suppresses what people write: words, paths and identifiers without digits, digits only, UUIDs, and
documentation's own sample keys. Spans of the fixed patterns are never suppressed.

Defined results: null text counts as empty and has no spans; positions are code points, the end exclusive; spans of different kinds
may share places, and of spans with one start the kinds come in the order of KINDS; repeated rows each give a row; long texts are
scanned whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.llm.common import let, prefix_sums

ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs of the needed length only: shorter maximal runs fail anyway.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
HEX_BITS, MIXED_BITS = 2.9, 3.7
ALLOWED = (
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|placeholder",
)
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"


def spans(text: Column, pattern: str, kind: str, keep) -> Column:
    """The pattern's leftmost non-overlapping matches as structs; keep(match) may be a condition on it."""
    rank = KINDS.index(kind)

    def placed(found: Column, between: Column) -> Column:
        before = F.transform(found, lambda m, i: F.char_length(F.get(between, i)).cast("long"))
        step = F.zip_with(before, found, lambda b, m: b + F.char_length(m))
        start = let(before, lambda x: F.zip_with(prefix_sums(step), x, lambda a, b: a + b))
        one = lambda s, m: F.struct(s.alias("start"), F.lit(rank).alias("rank"), (s + F.char_length(m)).alias("end"), F.lit(kind).alias("kind"), m.alias("value"))
        return F.filter(F.zip_with(start, found, one), lambda x: keep(x["value"]))

    some = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: let(F.split(text, pattern, -1), lambda between: placed(found, between)))
    return F.when(F.rlike(text, F.lit(pattern)), some.cast(SPAN)).otherwise(F.array().cast(SPAN))


def largest_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any window of the string, by incremental counts; under one window: 0."""
    term = F.array(*[F.lit(c * math.log2(c) if c > 1 else 0.0) for c in range(window + 2)])
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)
    return let(codes, lambda x: _folded(x, term, window))


def _folded(codes: Column, term: Column, window: int) -> Column:
    start = F.struct(
        F.array_repeat(F.lit(0), len(SYMBOLS)).alias("count"), F.lit(0.0).cast("double").alias("sum"), F.lit(0.0).cast("double").alias("best"), F.lit(0).alias("i")
    )

    def step(acc: Column, code: Column) -> Column:
        gone = F.when(acc["i"] >= window, F.get(codes, acc["i"] - window)).otherwise(F.lit(-1))
        came_n, gone_n = F.get(acc["count"], code), F.get(acc["count"], gone)
        total = acc["sum"] + F.get(term, came_n + 1) - F.get(term, came_n)
        total = total + F.when(gone >= 0, F.get(term, gone_n - 1) - F.get(term, gone_n)).otherwise(F.lit(0.0))
        total = F.when(gone == code, acc["sum"]).otherwise(total)
        count = F.transform(acc["count"], lambda c, j: c + F.when(j == code, F.lit(1)).otherwise(F.lit(0)) - F.when(j == gone, F.lit(1)).otherwise(F.lit(0)))
        bits = F.lit(math.log2(window)) - total / window
        best = F.when(acc["i"] >= window - 1, F.greatest(acc["best"], bits)).otherwise(acc["best"])
        return F.struct(count.alias("count"), total.alias("sum"), best.alias("best"), (acc["i"] + 1).alias("i"))

    return F.aggregate(codes, start, step, lambda acc: acc["best"])


def allowed(value: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | F.rlike(value, F.lit(pattern))
    return out


def entropy_spans(text: Column) -> Column:
    hexed = lambda v: F.rlike(v, F.lit(r"^(?:[0-9a-f]+|[0-9A-F]+)$"))
    high = lambda v: let(largest_entropy(v), lambda e: e >= F.when(hexed(v), HEX_BITS).otherwise(MIXED_BITS))
    found = spans(text, CANDIDATE, "entropy_mixed", lambda v: F.when(allowed(v), False).otherwise(high(v)))
    as_hex = lambda x: x.withField("kind", F.lit("entropy_hex")).withField("rank", F.lit(KINDS.index("entropy_hex")))
    return F.transform(found, lambda x: F.when(hexed(x["value"]), as_hex(x)).otherwise(x)).cast(SPAN)


def base_spans(text: Column) -> Column:
    parts = [
        spans(text, ASSIGN, "assign", lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
        spans(text, ACCESS, "access", lambda m: F.lit(True)),
        spans(text, HEX, "hex", lambda m: F.lit(True)),
    ]
    return F.concat(*parts)


def listed(found: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base and more (arrays of spans with their values) for every row."""
    text = F.coalesce("text", F.lit(""))
    some = docs.select("doc_id", text.alias("text"))
    return some.select("doc_id", base_spans(F.col("text")).alias("base"), entropy_spans(F.col("text")).alias("more"))


def report(docs: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "more")).alias("spans"),
    )
