"""Secret scan in DataFrame functions only: fixed formats, and a battery of randomness tests for everything else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The formats, the least length of what they must hold, and their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {"assign": (ASSIGN, 12), "access": (r"AKIA[A-Z0-9]+", 18), "hex": (r"[0-9a-f]{16,}", 16)}
RANDOM = "random"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
# Inferred encodings: the pattern of the whole token, alphabet size, share of equal pairs in ordinary text of that alphabet.
ENCODINGS = {"hex": (r"^(?=.*[0-9])(?=.*[A-Fa-f])([0-9a-f]+|[0-9A-F]+)$", 16, .12),
             "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", 32, .08),
             "base64": (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/_-]+$", 64, .055)}
DISCOVERY, REJECTION = .01, .001
# Matches are set between two of these; one in a text is read as its neighbour, so that positions hold.
MARK, STAND_IN = "￿", "￾"
MASK = "[secret]"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>>: leftmost matches that do not overlap, in code points."""
    pieces = F.split(F.regexp_replace(text, F.lit(f"({pattern})"), F.lit(f"{MARK}$1{MARK}")), MARK, -1)
    kind = "array<struct<start:bigint,end:bigint,value:string>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("hit"), F.array().cast(kind).alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        found = F.struct(acc["at"].alias("start"), end.alias("end"), piece.alias("value"))
        return F.struct(end.alias("at"), (~acc["hit"]).alias("hit"),
                        F.when(acc["hit"], F.array_append(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(pieces, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))


def base_spans(text: Column, kind: str) -> Column:
    pattern, least = KINDS[kind]
    found = matches(text, pattern)
    if kind == "assign":
        return F.filter(found, lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= least)
    return F.filter(found, lambda m: F.length(m["value"]) >= least)


def _normal(z: Column) -> Column:
    """The normal distribution function, by a logistic curve (error below 0.0002)."""
    return 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -1.5976 * z - 0.070565 * z * z * z))))


def _pick(value: Column, of: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for name, x in of.items():
        out = F.when(value == name, F.lit(float(x))).otherwise(out)
    return out


def encoding(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (pattern, _, _) in reversed(ENCODINGS.items()):
        out = F.when(token.rlike(pattern), name).otherwise(out)
    return out


def _sum(array: Column, term) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + term(x))


def _more(df: DataFrame, kept: list[str], **fields) -> tuple[DataFrame, list[str]]:
    """Adds fields to every struct of `_tests`, in a step of its own: each is an expression over the fields before."""
    return (df.withColumn("_tests", F.transform("_tests", lambda t: F.struct(
        *[t[k].alias(k) for k in kept], *[f(t).alias(k) for k, f in fields.items()]))), [*kept, *fields])


def test_tokens(df: DataFrame) -> DataFrame:
    """Adds to the structs of `_tests` p_text and p_random: how likely ordinary text is as even, a random token as uneven.

    The battery: chi-squared of the alphabet's uniformity, runs above and below the middle of the codes, and serial
    correlation of neighbours; p_random is three times the smallest p. p_text comes from the share of equal pairs.
    """
    size, share = ({n: v[i] for n, v in ENCODINGS.items()} for i in (1, 2))
    df, kept = _more(df, ["start", "end"], n=lambda t: F.length(t["value"]).cast("double"),
                     k=lambda t: _pick(t["kind"], size), share=lambda t: _pick(t["kind"], share), value=lambda t: t["value"],
                     codes=lambda t: F.transform(F.filter(F.split(t["value"], ""), lambda c: c != ""), lambda c: F.ascii(c).cast("double")))
    df, kept = _more(df, kept, mean=lambda t: _sum(t["codes"], lambda c: c) / t["n"],
                     middle=lambda t: F.element_at(F.array_sort(t["codes"]), F.ceil(t["n"] / 2).cast("int")),
                     squares=lambda t: _sum(F.array_distinct(t["codes"]), lambda c: F.pow(F.size(F.filter(t["codes"], lambda x: x == c)), F.lit(2.0))),
                     beside=lambda t: F.arrays_zip(F.slice(t["codes"], 1, F.size(t["codes"]) - 1).alias("a"),
                                                   F.slice(t["codes"], 2, F.size(t["codes"])).alias("b")))
    df, kept = _more(df, kept, above=lambda t: _sum(t["codes"], lambda c: (c > t["middle"]).cast("double")),
                     runs=lambda t: 1 + _sum(t["beside"], lambda p: ((p["a"] > t["middle"]) != (p["b"] > t["middle"])).cast("double")),
                     spread=lambda t: _sum(t["codes"], lambda c: (c - t["mean"]) * (c - t["mean"])),
                     serial=lambda t: _sum(t["beside"], lambda p: (p["a"] - t["mean"]) * (p["b"] - t["mean"])))
    kept = [k for k in kept if k not in ("codes", "beside", "value", "middle", "mean")]
    df, kept = _more(df, kept, both=lambda t: 2 * t["above"] * (t["n"] - t["above"]), all=lambda t: t["n"] * (t["n"] - 1) / 2)
    df, kept = _more(df, kept, chi_z=lambda t: (t["k"] / t["n"] * t["squares"] - t["n"] - (t["k"] - 1)) / F.sqrt(2 * (t["k"] - 1) * (t["n"] - 1) / t["n"]),
                     variance=lambda t: t["both"] * (t["both"] - t["n"]) / (t["n"] * t["n"] * (t["n"] - 1)),
                     serial_z=lambda t: F.when(t["spread"] > 0, t["serial"] / t["spread"] * F.sqrt(t["n"])).otherwise(F.lit(9.0)),
                     text_z=lambda t: ((t["squares"] - t["n"]) / 2 - t["all"] * t["share"]) / F.sqrt(t["all"] * t["share"] * (1 - t["share"])))
    df, kept = _more(df, kept, runs_z=lambda t: F.when(t["variance"] > 0, (t["runs"] - t["both"] / t["n"] - 1) / F.sqrt(t["variance"])).otherwise(F.lit(-9.0)))
    return _more(df, ["start", "end"], p_text=lambda t: _normal(t["text_z"]), p_random=lambda t: F.least(F.lit(1.0), 3 * F.least(
        1 - _normal(t["chi_z"]), 2 * _normal(-F.abs(t["runs_z"])), 2 * _normal(-F.abs(t["serial_z"])))))[0]


def random_spans(df: DataFrame, whole: str, base: str) -> DataFrame:
    """Adds `_random`: tokens that pass the battery and, by the step-up rule over the text's tokens, are not ordinary text.

    The rule weighs a token's p_text by its length over the mean length, so that long tokens, where the tests have
    power, get the larger part of the allowed false discoveries.
    """
    tokens = F.transform(matches(F.col(whole), TOKEN), lambda m: F.struct(m["start"], m["end"], m["value"], encoding(m["value"]).alias("kind")))
    df = df.withColumn("_tests", tokens).withColumn("_tests", F.filter("_tests", lambda m: m["kind"].isNotNull() & ~F.exists(
        base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))))
    df = test_tokens(df).withColumn("_length", _sum(F.col("_tests"), lambda t: t["end"] - t["start"]) / F.nullif(F.size("_tests"), F.lit(0)))
    df = df.withColumn("_tests", F.array_sort(F.transform("_tests", lambda t: F.struct(
        (t["p_text"] * F.col("_length") / (t["end"] - t["start"])).alias("p"), t["start"], t["end"], t["p_random"].alias("even")))))
    limits = F.transform("_tests", lambda t, i: F.when(t["p"] <= (i + 1) * DISCOVERY / F.size("_tests"), t["p"]).otherwise(-1.0))
    df = df.withColumn("_limit", F.coalesce(F.array_max(limits), F.lit(-1.0)))
    return df.withColumn("_random", F.filter("_tests", lambda t: (t["p"] <= F.col("_limit")) & (t["even"] >= REJECTION)))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds `_assign`, `_access`, `_hex`, `_random` (arrays of spans) and `_spans`, all in order of start, then kind.

    Null text is empty; rows are independent of each other, so repeated rows repeat their result.
    """
    out = df.withColumn("_whole", F.translate(F.coalesce(F.col(text), F.lit("")), MARK, STAND_IN))
    out = out.withColumns({f"_{k}": base_spans(F.col("_whole"), k) for k in KINDS})
    out = out.withColumn("_base", F.concat(*[F.transform(f"_{k}", lambda m: F.struct(m["start"], m["end"])) for k in KINDS]))
    out = random_spans(out, "_whole", "_base")
    names = [*KINDS, RANDOM]
    every = F.concat(*[_named(f"_{k}", i, k) for i, k in enumerate(names)])
    return out.withColumn("_spans", F.array_sort(every))


def _named(spans: str, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda m: F.struct(m["start"], F.lit(rank).alias("rank"), m["end"], F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, their digest, and all spans as text."""
    found = scan(documents.select("doc_id", "text"))
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.filter("_spans", lambda s: s["kind"] != RANDOM)
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))


def mask(documents: DataFrame, text: str = "text") -> DataFrame:
    """Replaces every span (overlapping ones as one) by a mark; null texts stay null, other columns are untouched."""
    rows = documents.select(F.struct(*documents.columns).alias("_row"), F.col(text).alias("_text"))
    found, own = scan(rows, "_text"), F.col("_text")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(own, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        beyond = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(beyond, F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"]).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(own, (acc["at"] + 1).cast("int"), F.length(own)))

    masked = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step, finish)).otherwise(own)
    return found.select(*[masked.alias(c) if c == text else F.col("_row")[c].alias(c) for c in documents.columns])
