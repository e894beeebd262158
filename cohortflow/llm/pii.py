"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Four base patterns find what is certain. High-recall generators then propose further spans, which may
overlap: written-out mail addresses, IPv6 addresses, and number runs, each as a card and as a phone
number. Gradient-boosted trees score every proposal on its format and context. They are fitted on
the proposals of all documents, where those that the base patterns confirm are the positives; a fifth
of the documents is held back from the trees and sets the thresholds. A proposal is accepted if it scores
as well as most confirmed ones of its kind there, overlaps no base span, and no better proposal covers
its place. A kind without confirmed proposals among the held ones adds nothing.

Everything runs inside one projection per document: no shuffle, no Python. Positions follow from the
lengths of the pieces around the matches. The patterns are possessive where they can be, so texts of
any length are matched without recursion and in linear time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read, uniform
from cohortflow.session import stage

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. A run is only entered at its first character, and never left half-way.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of 16 to 19 digits as a whole; all others fail the count in any case.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[\[({](?i:at)[\])}]\x20?|\x20(?i:at)\x20|@)"
_DOT = r"(?:\x20?[\[({](?i:dot)[\])}]\x20?|\x20(?i:dot)\x20|\.)"
GENERATORS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    # Written out, or with one run of zeros left out.
    "ip": r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?"
    r"|::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})(?![0-9A-Za-z:])",
    "number": r"(?:\+|\(|(?<![0-9]))[0-9](?:[\x20().-]{0,2}[0-9]){6,18}+",
}
#: Words near a span that speak for its kind.
CONTEXT = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|server|host|address",
    "card": r"(?i)card|visa|credit|payment",
    "phone": r"(?i)phone|call|\btel|mobile|fax",
}
FEATURES = (
    "kind", "digits", "length", "separators", "letters", "inside_left", "inside_right", "opened",
    "groups", "longest_group", "luhn", "context",
)
TREES, DEPTH = 10, 3
#: An accepted span scores no worse than all but this share of confirmed ones, and this at least.
MISSED, LEAST_SCORE = 0.05, 0.9
_CHUNK = 256


class Scorer(NamedTuple):
    """Flattened trees (weight, nested splits) and the threshold of each kind."""

    trees: list
    thresholds: dict[str, float]


def _running(lengths: Column) -> Column:
    """Sums of the lengths ahead of each place; in chunks, so long arrays are not copied at each step."""

    def extend(state: Column, n: Column) -> Column:
        return F.struct((state["at"] + n).alias("at"), F.array_append(state["all"], state["at"]).alias("all"))

    def sums(numbers: Column, start: Column) -> Column:
        first = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(numbers, first, extend, lambda s: s["all"])

    chunk = lambda c: F.slice(lengths, c * _CHUNK + 1, _CHUNK)
    chunks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int"))
    totals = F.transform(chunks, lambda c: F.aggregate(chunk(c), F.lit(0), lambda a, n: a + n))
    bases = sums(totals, F.lit(0))
    parts = F.transform(F.arrays_zip(chunks.alias("c"), bases.alias("b")), lambda x: sums(chunk(x["c"]), x["b"]))
    return F.when(F.size(lengths) > 0, F.flatten(parts)).otherwise(F.array().cast("array<int>"))


def _located(df: DataFrame, patterns: dict[str, str], prefix: str) -> DataFrame:
    """Adds ``prefix + name``: ``array<struct<start, end, text>>`` of a pattern's matches in ``text``."""
    none = F.array().cast("array<string>")
    may = {name: F.col("text").contains("@") | F.lower("text").contains("at") if name == "email" and prefix == "c_"
           else F.col("text").contains("@") if name == "email" else F.col("text").rlike("[0-9]") for name in patterns}
    if prefix == "c_":
        may["ip"] = F.col("text").contains(":")
    else:
        may["phone"] = may["phone"] & F.col("text").contains("+")
    for name, pattern in patterns.items():
        df = df.withColumn("_m", F.when(may[name], F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
        df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split("text", pattern, -1)).otherwise(none))
        # Zipped, not looked up from within the lambda: there the optimiser would repeat the split per match.
        gaps = F.slice("_g", 1, F.size("_m")).alias("g")
        pairs = F.arrays_zip(F.col("_m").alias("m"), gaps)
        df = df.withColumn("_l", F.transform(pairs, lambda x: F.length(x["m"]) + F.length(x["g"])))
        df = df.withColumn("_r", _running(F.col("_l")))

        def span(x: Column) -> Column:
            start = x["r"] + F.length(x["g"])
            return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("text"))

        located = F.transform(F.arrays_zip(F.col("_m").alias("m"), gaps, F.col("_r").alias("r")), span)
        df = df.withColumn(prefix + name, located).drop("_m", "_g", "_l", "_r")
    return df


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _holds(kind: str, text: Column) -> Column:
    if kind == "ip":
        short = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.call_function("luhn_check", _digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def _passing(kind: str) -> Column:
    return F.filter(f"b_{kind}", lambda s: _holds(kind, s["text"]))


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with ``b_email, b_ip, b_card, b_phone``; null texts count as empty."""
    rows = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows = _located(rows, BASE, "b_")
    return rows.withColumns({f"b_{k}": _passing(k) for k in KINDS})


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def proposals(rows: DataFrame) -> DataFrame:
    """Adds ``proposed``: spans with their kind, features, and whether a base span of the kind meets them."""
    rows = _located(rows, GENERATORS, "c_")

    def features(kind: str, s: Column) -> Column:
        text = s["text"]
        left = F.when(s["start"] > 0, F.substr(F.col("text"), s["start"], F.lit(1))).otherwise("")
        right = F.substr(F.col("text"), s["end"] + 1, F.lit(1))
        near = F.substr(F.col("text"), F.greatest(s["start"] - 39, F.lit(1)), F.least(s["start"], F.lit(40)))
        groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
        yes = lambda c: c.cast("double")
        values = {
            "kind": F.lit(float(KINDS.index(kind))),
            "digits": F.length(_digits(text)).cast("double"),
            "length": F.length(text).cast("double"),
            "separators": F.length(F.regexp_replace(text, "[0-9A-Za-z+]", "")).cast("double"),
            "letters": F.length(F.regexp_replace(text, "[^A-Za-z]", "")).cast("double"),
            "inside_left": yes(left.rlike("[0-9A-Za-z.]")),
            "inside_right": yes(right.rlike("[0-9A-Za-z]")),
            "opened": yes(text.rlike(r"^[+(]")),
            "groups": F.size(groups).cast("double"),
            "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)).cast("double"),
            "luhn": yes(F.coalesce(F.call_function("luhn_check", _digits(text)), F.lit(False))),
            "context": yes(near.rlike(CONTEXT[kind])),
        }
        base = F.exists(f"b_{kind}", lambda b: _overlaps(b, s))
        return F.struct(
            F.lit(kind).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            base.alias("confirmed"),
            F.array(*[values[name] for name in FEATURES]).alias("f"),
        )

    sources = {"email": "c_email", "ip": "c_ip", "card": "c_number", "phone": "c_number"}
    listed = lambda kind: F.transform(sources[kind], lambda s: features(kind, s))
    found = [listed(k) for k in KINDS]
    # Dotted quads that a base pattern found are proposals too, or no address of that kind is confirmed.
    found.append(F.transform("b_ip", lambda s: features("ip", s)))
    return rows.withColumn("proposed", F.concat(*found)).drop(*[f"c_{name}" for name in GENERATORS])


def _flat(model: GBTClassificationModel) -> list:
    """``(weight, node)`` per tree; a node is a float, or (feature, threshold, left, right)."""

    def node(n):
        if n.getClass().getSimpleName() == "LeafNode":
            return float(n.prediction())
        split = n.split()
        return (int(split.featureIndex()), float(split.threshold()), node(n.leftChild()), node(n.rightChild()))

    return [
        (float(w), node(tree._call_java("rootNode"))) for w, tree in zip(model.treeWeights, model.trees, strict=True)
    ]


def score(trees: list, f: Column) -> Column:
    """Probability of a feature array under the flattened trees, as one expression."""

    def value(n) -> Column:
        if isinstance(n, float):
            return F.lit(n)
        at, threshold, left, right = n
        return F.when(F.get(f, F.lit(at)) <= threshold, value(left)).otherwise(value(right))

    margin = sum((F.lit(w) * value(n) for w, n in trees), F.lit(0.0))
    return 1 / (1 + F.exp(-2 * margin))


def fit(docs: DataFrame) -> Scorer | None:
    """Trees and thresholds from the proposals of all ``docs``; None without confirmed or without other ones.

    Proposals that agree in all features are one weighted row, so fitting costs what the different ones cost.
    """
    # explode would have its input tested for size in the scan, which spells all patterns out once more.
    rows = proposals(base_spans(docs)).select("doc_id", F.explode_outer("proposed").alias("p")).where("p IS NOT NULL").select(
        (uniform(F.col("doc_id"), seed="pii-held") < 0.2).alias("held"), "p.kind", "p.f", F.col("p.confirmed").cast("double").alias("label")
    )
    rows = stage(rows.groupBy("held", "kind", "f", "label").agg(F.count(F.lit(1)).alias("n")), "pii-proposals")
    if rows.where("NOT held").select("label").distinct().count() < 2:
        return None
    weight = F.col("n").cast("double").alias("weight")
    training = rows.where("NOT held").select("label", array_to_vector("f").alias("features"), weight)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3, maxBins=64, weightCol="weight").fit(training)
    trees = _flat(model)
    # Thresholds come from rows that the trees have not seen.
    scored = rows.where("held AND label = 1").select("kind", score(trees, F.col("f")).alias("s"), "n")
    lows = scored.groupBy("kind").agg(F.percentile("s", MISSED, F.col("n")).alias("low")).collect()
    return Scorer(trees, {row["kind"]: max(row["low"], LEAST_SCORE) for row in lows})


def find(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """``doc_id, text, base, spans`` per row: ``array<struct<kind, start, end>>``, by kind, then start.

    Without a ``scorer`` one is fitted on ``docs`` themselves.
    ``base`` holds what the base patterns find, ``spans`` also what the trees add. Null texts count as
    empty. Nothing found gives empty arrays. Repeated rows are treated alike. Without any confirmed
    proposal (an empty table, say) nothing is added.
    """
    scorer = scorer or fit(docs)
    rows = base_spans(docs)
    plain = lambda name, kind: F.transform(
        name, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    base = F.concat(*[plain(f"b_{k}", k) for k in KINDS])
    if scorer is None:
        return rows.select("doc_id", "text", base.alias("base"), base.alias("spans"))
    limit = F.create_map(*[F.lit(x) for k in KINDS for x in (k, scorer.thresholds.get(k, 2.0))])
    rows = proposals(rows).withColumn("base", base)
    rows = rows.withColumn(
        "open", F.filter("proposed", lambda p: ~F.exists("base", lambda b: _overlaps(b, p)))
    ).drop("proposed")
    rows = rows.withColumn(
        "open",
        F.transform(
            "open",
            lambda p: F.struct(
                (-score(scorer.trees, p["f"])).alias("cost"), p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind")
            ),
        ),
    )
    good = F.array_sort(F.filter("open", lambda p: -p["cost"] >= F.element_at(limit, p["kind"])))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")

    def keep(kept: Column, p: Column) -> Column:
        mine = F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"))
        return F.when(F.exists(kept, lambda k: _overlaps(k, p)), kept).otherwise(F.array_append(kept, mine))

    rows = rows.withColumn("added", F.when(F.size("open") > 0, F.aggregate(good, empty, keep)).otherwise(empty))
    ordered = lambda kind: F.array_sort(F.filter(F.concat("base", "added"), lambda s: s["kind"] == kind))
    return rows.select("doc_id", "text", "base", F.concat(*[ordered(k) for k in KINDS]).alias("spans"))


def redact(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """``doc_id, text`` with every found span replaced by its kind in angle brackets.

    Where spans of two kinds overlap, the one that starts first (then the longer) covers the rest.
    """
    found = find(docs, scorer)
    by_start = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind")))
    )
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(state: Column, s: Column) -> Column:
        piece = F.substr(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        mark = F.concat(F.lit("<"), s["kind"], F.lit(">"))
        after = F.struct(
            (-s["last"]).alias("at"), F.concat(state["parts"], F.array(piece, mark)).alias("parts")
        )
        return F.when(s["start"] < state["at"], state).otherwise(after)

    done = F.aggregate(by_start, first, cut)
    found = found.withColumn("done", done)
    rest = F.substr(F.col("text"), F.col("done.at") + 1, F.length("text"))
    return found.select("doc_id", F.concat(F.array_join("done.parts", ""), rest).alias("text"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    found = find(read(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )
