"""Secret scan: fixed patterns, and a randomness test battery for the rest.

Patterns give the base spans (``assign``, ``access``, ``hex``).  Every other
run of at least 20 key characters whose encoding can be inferred (hex, base 32,
base 36 or base 64, with letters and digits) is put to three tests of being
uniformly random over its alphabet: chi-squared of the symbol counts (through
the cube-root normal approximation), the runs test of upper and lower half of
the alphabet, and the lag-one serial correlation.  Fisher's method combines
their p-values.  False-discovery control is length-aware: within each encoding
and length class (powers of two) the step-up procedure at rate ``q`` over all
documents says which runs are *not* random; those it cannot reject are spans
``random``.

DataFrame functions only: one pass over the texts, a bounded table of counts by
(encoding, length class, p-value step), and at most ``4 x 32`` limits read back.

Defined results: a null text is empty and has no spans; positions count code
points, ends are exclusive; repeated rows give repeated results; other columns
are ignored; a run that base spans cover whole is not reported twice, one that
they cover in part is a run like any other, and its span may overlap theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.llm.common import checkpoint

# The base patterns, by their listed order, with the least length
# of the group that decides.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24)]
KEY_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])"
# name, test, alphabet; the first that fits is the encoding
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$|^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$|^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
STEPS = 50  # p-value steps to a factor of e

SPAN = "array<struct<s:int,e:int,m:string>>"


def find(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """(start, end, match) of the pattern's leftmost non-overlapping matches
    whose ``group`` has at least ``least`` characters."""
    whole, part = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.char_length(x["gap"])
        e = s + F.char_length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.when(F.char_length(x["g"]) >= least, F.array(
            F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).otherwise(none)).alias("out"))

    parts = F.transform(whole, lambda m, i: F.struct(F.get(gaps, i).alias("gap"), m.alias("m"), F.get(part, i).alias("g")))
    return F.when(text.rlike(pattern), F.aggregate(parts, start, add, lambda acc: acc["out"])).otherwise(none)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal by the logistic approximation."""
    return let(F.greatest(F.lit(-8.0), F.least(F.lit(30.0), z)),
               lambda v: 1 / (1 + F.exp(0.07056 * v * v * v + 1.5976 * v)))


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once: a lambda's variable is
    bound to it, where a plain column would be computed at every use."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def lag_sum(x: Column, pair) -> Column:
    """Sum of ``pair`` over the neighbours of an array, in one walk."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(x, start, lambda acc, v: F.struct(v.alias("last"), (acc["sum"] + F.when(
        acc["last"].isNotNull(), pair(acc["last"], v)).otherwise(0.0)).alias("sum")), lambda acc: acc["sum"])


def battery(codes: Column, size: int) -> Column:
    """Combined p-value of a run's symbol codes (doubles) being uniform over
    ``size`` symbols."""
    return let(codes, lambda c: let(F.size(c).cast("double"), lambda n: _battery(c, n, size)))


def _battery(codes: Column, n: Column, size: int) -> Column:
    squares = total(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda a: F.pow(
        F.size(F.filter(codes, lambda c: c == a)).cast("double"), F.lit(2.0))))
    df = float(size - 1)
    chi = (F.pow(F.greatest(squares * size / n - n, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    high = F.transform(codes, lambda c: (c >= size // 2).cast("double"))
    turns = 1 + lag_sum(high, lambda x, y: F.abs(x - y))

    def runs(ones: Column) -> Column:
        mean = 2 * ones * (n - ones) / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        return F.least(F.abs(turns - mean) / spread, F.lit(30.0))

    def serial(away: Column) -> Column:
        var = F.greatest(total(F.transform(away, lambda d: d * d)), F.lit(1e-9))
        return F.abs(lag_sum(away, lambda x, y: x * y) / var) * F.sqrt(n)

    away = let(total(codes) / n, lambda m: F.transform(codes, lambda c: c - m))
    log = lambda p: -F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-150)))
    x = log(upper_tail(chi)) + log(2 * upper_tail(let(total(high), runs))) + log(2 * upper_tail(let(away, serial)))
    return let(x, lambda v: F.exp(-v) * (1 + v + v * v / 2))


def codes_of(letters: Column, alphabet: str) -> Column:
    """Place of every character in the alphabet."""
    return F.transform(F.split(letters, ""), lambda c: (F.call_function("instr", F.lit(alphabet), c) - 1).cast("double"))


def tested(runs: Column) -> Column:
    """Runs with an inferred encoding: span, encoding's number, length, p."""
    def one(r: Column) -> Column:
        kind, p = F.lit(None).cast("int"), F.lit(None).cast("double")
        plain = F.regexp_replace(F.regexp_replace(r["m"], "-", "+"), "_", "/")
        for k, (_, test, alphabet) in reversed(list(enumerate(ENCODINGS))):
            fits = r["m"].rlike(test)
            letters = plain if k == 3 else F.lower(r["m"])
            codes = codes_of(letters, alphabet)
            kind = F.when(fits, k).otherwise(kind)
            p = F.when(fits, battery(codes, len(alphabet))).otherwise(p)
        return F.struct(r["s"].alias("s"), r["e"].alias("e"), kind.alias("k"),
                        F.floor(F.log2(F.char_length(r["m"]).cast("double"))).cast("int").alias("len"), p.alias("p"))

    return F.filter(F.transform(runs, one), lambda r: r["k"].isNotNull())


def named(found: Column, order: int, kind: str) -> Column:
    return F.transform(found, lambda r: F.struct(
        r["s"].alias("s"), F.lit(order).alias("o"), r["e"].alias("e"), F.lit(kind).alias("kind")))


def covered(run: Column, base: Column) -> Column:
    """True where the spans, in order of their starts, leave no part of the run."""
    return F.aggregate(base, run["s"], lambda at, b: F.when(
        b["s"] <= at, F.greatest(at, b["e"])).otherwise(at)) >= run["e"]


RUNS = "array<struct<s:int,e:int,k:int,len:int,p:double>>"


def _found(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """(kept, text, base spans, tested runs) of every row."""
    src = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = [named(find(F.col("text"), pattern, group, least), i, kind)
            for i, (kind, pattern, group, least) in enumerate(BASE)]
    runs = F.filter("runs", lambda r: ~covered(r, F.col("base")))
    return (src.withColumn("base", F.array_sort(F.concat(*base))).withColumn("runs", find(F.col("text"), KEY_RUN))
            .withColumn("runs", runs).withColumn("runs", F.when(F.size("runs") > 0, tested(F.col("runs"))))
            .withColumn("runs", F.coalesce("runs", F.array().cast(RUNS))))


def _random(found: DataFrame, q: float) -> Column:
    """Spans of the runs that the step-up procedure leaves as random."""
    runs = found.select(F.explode("runs").alias("r")).select("r.*")
    limit_of = {(r["k"], r["len"]): r["limit"] for r in fdr_limits(runs, q).collect()}  # one of each class

    def passes(r: Column) -> Column:
        least = F.lit(-1.0)
        for (k, n), p in sorted(limit_of.items()):
            least = F.when((r["k"] == k) & (r["len"] == n), F.lit(p)).otherwise(least)
        return r["p"] > least

    return named(F.filter("runs", passes), len(BASE), "random")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.05) -> DataFrame:
    """One row per document row: the id, ``base`` and ``random`` spans as arrays
    of (s, o, e, kind), o being the kind's order."""
    found = checkpoint(_found(docs, text_col, [id_col]).select("kept", "base", "runs"))
    return found.select("kept.*", "base", _random(found, q).alias("random"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = None, q: float = 0.05,
           mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, every span replaced by ``mark`` (overlapping spans
    by one).  ``chars_col`` is set anew where the text changed.  The texts are
    read twice, for the limits and for the spans; nothing is shuffled."""
    found = _found(docs, text_col, docs.columns)
    spans = F.array_sort(F.concat("base", _random(found, q)))
    text = F.col("text")
    parts = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, x: F.struct(
        F.greatest(acc["at"], x["e"]).alias("at"),
        F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark)))
        .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    out = found.withColumn("spans", spans).withColumn("new", F.when(F.size("spans") > 0, parts))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.coalesce("new", f"kept.{c}").alias(c))
        elif c == chars_col:
            cols.append(F.when(F.col("new").isNotNull(), F.char_length("new").cast(docs.schema[c].dataType))
                        .otherwise(F.col(f"kept.{c}")).alias(c))
        else:
            cols.append(F.col(f"kept.{c}").alias(c))
    return out.select(*cols)


def fdr_limits(runs: DataFrame, q: float) -> DataFrame:
    """(k, len, limit): p-values up to ``limit`` are rejected as random by the
    step-up procedure within the class; p-values count by steps, each at its
    upper edge, so the table has a bounded number of rows."""
    step = F.floor(-F.log(F.greatest("p", F.lit(1e-300))) * STEPS).cast("int")
    counts = runs.groupBy("k", "len", step.alias("step")).agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("k", "len")
    upto = by_class.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    edge = F.exp(-F.col("step") / F.lit(float(STEPS)))
    return (counts.withColumn("below", F.sum("n").over(upto)).withColumn("m", F.sum("n").over(by_class))
            .withColumn("edge", edge).where(F.col("edge") <= F.lit(q) * F.col("below") / F.col("m"))
            .groupBy("k", "len").agg(F.max("edge").alias("limit")))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat(
        x["kind"], F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest and text form of the spans of ``scan``."""
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long")
    return found.select(id_col, *[count(k).alias(f"n_{k}") for k, *_ in BASE],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("base", "random"))).alias("spans"),
                        F.size("random").cast("long").alias("n_random"))
