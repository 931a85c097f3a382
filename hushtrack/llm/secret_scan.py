"""Secret scan with a battery of randomness tests (operator 3), DataFrame operations only.

Fixed patterns find the base spans. The battery adds spans of kind ``random``: every run of 20 or
more characters that may encode bytes gets the smallest usual alphabet that holds it (its inferred
encoding), and three tests of the hypothesis that its characters are drawn evenly from that
alphabet: chi-squared uniformity, Wald-Wolfowitz runs above and below the middle of the alphabet,
and serial correlation at lag one. Fisher's method joins the three p-values. Benjamini-Hochberg
control of false discoveries, within each encoding and class of lengths (tests of short runs have
less power, and must not be drowned by those of long ones), decides which runs are not random; what
is left is reported.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.llm.common import shared, text_of

#: The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

#: Runs of so many characters, with a letter and a digit, are tested.
MIN_RUN = 20
_CLASS = "A-Za-z0-9+/_-"
RUN = (
    rf"(?<![{_CLASS}])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[{_CLASS}]{{{MIN_RUN},}}(?![{_CLASS}])"
)
#: Inferred encodings, smallest alphabet first.
ENCODINGS = (
    ("hex_lower", string.digits + "abcdef"),
    ("hex_upper", string.digits + "ABCDEF"),
    ("base32", string.ascii_uppercase + "234567"),
    ("base36_lower", string.digits + string.ascii_lowercase),
    ("base36_upper", string.digits + string.ascii_uppercase),
    ("base62", string.digits + string.ascii_uppercase + string.ascii_lowercase),
    ("base64", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"),
    ("base64_url", string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_"),
    ("base66", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/-_"),
)
FALSE_DISCOVERIES = 0.05
#: p-values are rounded up to this many steps per factor of ten before they are ranked.
STEPS = 1000
_SPAN = "array<struct<start:int,kind:int,end:int,found:string>>"


def running_sums(values: Column) -> Column:
    """Sums of the first 1, 2, … entries: each round adds what stands 1, 2, 4, … entries before.

    A step per entry that appends to an array would copy it at every entry.
    """

    def add(sums: Column, step: Column) -> Column:
        before = F.concat(F.array_repeat(F.lit(0), step), F.slice(sums, F.lit(1), F.size(sums) - step))
        return F.zip_with(sums, before, lambda a, b: a + b)

    rounds = F.length(F.bin(F.size(values).cast("long")))
    # Powers of two below the number of entries.
    steps = F.filter(
        F.transform(F.sequence(F.lit(0), rounds), lambda k: F.call_function("shiftleft", F.lit(1), k)),
        lambda step: step < F.size(values),
    )
    return F.aggregate(steps, values, add)


def found(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches whose group is long enough, in code points."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(between.alias("gap"), matches.alias("hit"), groups.alias("held"))
    none = F.expr("array()").cast(_SPAN)

    def spans(rows: Column) -> Column:
        sizes = F.transform(rows, lambda r: F.length(r["gap"]) + F.coalesce(F.length(r["hit"]), F.lit(0)))
        ended = F.transform(F.array(sizes), running_sums)[0]
        placed = F.zip_with(rows, ended, lambda r, end: F.struct(r.alias("row"), end.alias("end")))
        kept = F.filter(placed, lambda p: F.length(p["row"]["held"]) >= least)
        return F.transform(
            kept,
            lambda p: F.struct(
                (p["end"] - F.length(p["row"]["hit"])).alias("start"),
                F.lit(kind).alias("kind"),
                p["end"].alias("end"),
                p["row"]["hit"].alias("found"),
            ),
        )

    # An array of one entry gives its content a name, so that the text is searched once.
    named = F.transform(F.array(rows), spans)[0]
    return F.when(F.rlike(text, F.lit(pattern)), named).otherwise(none)


def _p_two_sided(z: Column) -> Column:
    """erfc(|z| / sqrt(2)) by a rational approximation (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / F.lit(2**0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def tested(runs: DataFrame) -> DataFrame:
    """Adds encoding, the p-values p_chi, p_runs, p_serial and the joint p of the column ``found``."""
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, letters in reversed(ENCODINGS):
        fits = F.rlike("found", F.lit("^[" + letters.replace("-", "\\-") + "]+$"))
        encoding = F.when(fits, F.lit(name)).otherwise(encoding)
        alphabet = F.when(fits, F.lit(letters)).otherwise(alphabet)
    df = runs.withColumns({"encoding": encoding, "alphabet": alphabet, "n": F.length("found").cast("double")})
    df = df.withColumn("k", F.length("alphabet").cast("double"))
    seen = lambda c: F.col("n") - F.length(F.replace(F.col("found"), c, F.lit("")))
    squares = F.aggregate(
        F.split("alphabet", ""), F.lit(0.0), lambda acc, c: acc + F.when(c == "", 0.0).otherwise(seen(c) * seen(c))
    )
    df = df.withColumn("chi", squares * F.col("k") / F.col("n") - F.col("n"))
    free = F.col("k") - 1
    # Wilson-Hilferty: the cube root of chi-squared over its degrees of freedom is nearly normal.
    z_chi = (F.cbrt(F.greatest(F.col("chi"), F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    upper = F.when(z_chi > 0, _p_two_sided(z_chi) / 2).otherwise(1 - _p_two_sided(z_chi) / 2)
    half = (F.col("k") / 2).cast("int")
    value = F.transform(
        F.filter(F.split("found", ""), lambda c: c != ""), lambda c: (F.call_function("locate", c, F.col("alphabet")) - 1).cast("double")
    )
    df = df.withColumns({"p_chi": upper, "values": value})
    df = df.withColumn("side", F.array_join(F.transform("values", lambda v: F.when(v < half, "0").otherwise("1")), ""))
    changes = (2 * F.length("side") - F.length(F.replace(F.col("side"), F.lit("01"), F.lit(""))) - F.length(F.replace(F.col("side"), F.lit("10"), F.lit("")))) / 2
    low = F.length(F.replace(F.col("side"), F.lit("1"), F.lit(""))).cast("double")
    high = F.col("n") - low
    mean = 2 * low * high / F.col("n") + 1
    var = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    # One side only: as far from random as can be.
    df = df.withColumn("p_runs", F.when(var > 0, _p_two_sided((changes + 1 - mean) / F.sqrt(var))).otherwise(F.lit(0.0)))
    average = F.aggregate("values", F.lit(0.0), lambda a, v: a + v) / F.col("n")
    # The average by name: inside the inner function it would be summed anew for every entry.
    centred = F.transform(F.array(average), lambda mean: F.transform("values", lambda v: v - mean))[0]
    df = df.withColumn("values", centred)
    spread = F.aggregate("values", F.lit(0.0), lambda a, v: a + v * v)
    after = F.slice("values", F.lit(2), (F.col("n") - 1).cast("int"))
    before = F.slice("values", F.lit(1), (F.col("n") - 1).cast("int"))
    serial = F.aggregate(F.zip_with(before, after, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    z_serial = (serial / spread + 1 / F.col("n")) * F.sqrt(F.col("n"))
    df = df.withColumn("p_serial", F.when(spread > 0, _p_two_sided(z_serial)).otherwise(F.lit(0.0)))
    least = F.lit(1e-300)
    x = -(F.log(F.greatest("p_chi", least)) + F.log(F.greatest("p_runs", least)) + F.log(F.greatest("p_serial", least)))
    joint = F.exp(-x) * (1 + x + x * x / 2)
    return df.withColumn("p", F.least(F.lit(1.0), F.greatest(joint, least))).drop("values", "side", "alphabet", "k", "chi")


def not_random(tests: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """Benjamini-Hochberg thresholds: encoding, size_class, least ``step`` that is rejected.

    Ranks are taken over counts per step of the p-value, so no sort of all tests is needed.
    """
    per = tests.groupBy("encoding", "size_class", "step").agg(F.count(F.lit(1)).alias("n"))
    stratum = Window.partitionBy("encoding", "size_class")
    small_first = stratum.orderBy(F.desc("step"))
    ranked = per.withColumns({"rank": F.sum("n").over(small_first), "all": F.sum("n").over(stratum)})
    p = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    return (
        ranked.where(p <= level * F.col("rank") / F.col("all"))
        .groupBy("encoding", "size_class")
        .agg(F.min("step").alias("rejected_from"))
    )


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    line = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), line), ",")


def secret_spans(docs: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    spans lists kind:start:end by start, then kind (assign, access, hex, random), joined by commas;
    code points, end exclusive; base_sha256 is the digest of the list without kind random. A null
    text counts as empty and has no spans. Repeated rows each get a row and each count as tests; an
    empty table gives an empty result; other columns are ignored.
    """
    text = F.col("text")
    base = F.concat(
        found(text, ASSIGN, 0, 1, MIN_ASSIGN),
        found(text, ACCESS, 1, 0, MIN_ACCESS),
        # Runs are maximal, so only those long enough need to be found.
        found(text, HEX[:-1] + f"{{{MIN_HEX},}}", 2, 0, MIN_HEX),
    )
    rows = shared(
        docs.select("doc_id", text_of().alias("text")).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", base.alias("base"), found(text, RUN, 3, 0, MIN_RUN).alias("runs")
        ),
        "spans",
    )
    runs = rows.select("row", F.explode("runs").alias("run")).select("row", "run.*")
    # Lengths by factors of the square root of two.
    sizes = F.floor(2 * F.log2("n")).cast("int")
    tests = tested(runs).withColumns({"size_class": sizes, "step": F.floor(-F.log10("p") * STEPS).cast("int")})
    tests = shared(tests.select("row", "start", "kind", "end", "encoding", "size_class", "step"), "tests")
    random = tests.join(not_random(tests, level), ["encoding", "size_class"], "left")
    random = random.where("rejected_from is null or step < rejected_from")
    found_random = random.groupBy("row").agg(
        F.collect_list(F.struct("start", "kind", "end", F.lit("").alias("found"))).alias("random")
    )
    out = rows.drop("runs").join(found_random, "row", "left")
    extra = F.coalesce("random", F.expr("array()").cast(_SPAN))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", extra)).alias("spans"),
        F.size(extra).cast("long").alias("n_random"),
    )
