"""Personal data: fixed shapes, and identifiers that the words around them give away.

Bootstrapped contextual extraction: spans of the fixed shapes are seeds; the words before and after them
are patterns; patterns and candidate strings score each other over some rounds; strings in the
company of patterns that nearly always stand beside an identifier are found although no shape knows
them. Columns only, no Python code on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import staged, with_row_key, words_of

KINDS = ("email", "ip", "card", "phone", "context")
#: Rounds in which patterns and candidates score each other.
ROUNDS = 3
#: Different strings that must have stood in a pattern, and the share of a pattern's places that hold identifiers.
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.5
#: Places without identifier that every pattern is charged beforehand.
PRIOR = 2.0
#: So many words, of some ten bytes each, may be sent to every task.
SENT_WORDS = 200_000

_LOCAL = "[A-Za-z0-9._%+-]"
#: For each kind: what a text must hold to be searched at all, and the shape. A shape starts where the
#: search stands or where its first run of signs begins, so long runs are read once; runs never give
#: signs back, because what follows a run can't begin with one of its signs.
_SHAPES = {
    "email": ("@", rf"(?:|(?s:.*?)(?<!{_LOCAL}))", rf"{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?s:.*?)(?<![0-9])", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){13}", r"(?s:.*?)", r"[0-9](?:[\x20-]?[0-9]){13,}+"),
    "phone": (r"\+[0-9]", r"(?s:.*?)", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_NO_SPANS = "array<struct<kind:string,start:int,end:int>>"


def _matches(text: Column, needed: str, before: str, shape: str) -> Column:
    """All matches as (start, end, value), leftmost first, in code points.

    Each match is read together with what lies between it and the one before, so places are sums of
    lengths; the anchor keeps the search from starting again inside what no match follows.
    """
    pattern = F.lit(rf"\G({before})({shape})")
    gaps = F.transform(F.regexp_extract_all(text, pattern, F.lit(1)), lambda x: F.length(x))
    pairs = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + F.length(x["value"])
        found = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(a["out"], found).alias("out"))

    summed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return F.when(text.rlike(needed), summed).otherwise(none)


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return (F.length(digits) <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _kept(kind: str) -> Column:
    rank = list(_SHAPES).index(kind)

    def span(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"))

    return F.transform(F.filter("_m", lambda x: _holds(kind, x["value"])), span)


def with_base(docs: DataFrame) -> DataFrame:
    """Add ``base``: spans (kind, start, end) of the fixed shapes, by start, then kind as listed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    for kind, (needed, before, shape) in _SHAPES.items():
        docs = docs.withColumn("_m", _matches(text, needed, before, shape)).withColumn(f"_{kind}", _kept(kind)).drop("_m")
    ordered = F.array_sort(F.concat(*[f"_{kind}" for kind in _SHAPES]))
    base = F.transform(ordered, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return docs.withColumn("base", base).drop(*[f"_{kind}" for kind in _SHAPES])


def _edge(word: Column) -> Column:
    """A word as part of a pattern: in lower case, any digit for all digits."""
    return F.regexp_replace(F.lower(word), "[0-9]", "0")


def with_strings(docs: DataFrame) -> DataFrame:
    """Add ``strings``: every word with a digit or an at sign, as (start, end, value, left, right)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    word = r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*"
    places = _matches(text, "[0-9@]", r"(?s:.*?)(?<![^\x20\x09-\x0D])", word)
    words = F.when(text.rlike("[0-9@]"), words_of(text)).otherwise(F.array().cast("array<string>"))
    docs = docs.withColumn("_words", words).withColumn("_places", places)
    own = F.filter(F.transform("_words", lambda w, i: F.when(w.rlike("[0-9@]"), i)), lambda i: i.isNotNull())

    def placed(x: Column, k: Column) -> Column:
        i = F.get(F.col("_own"), k)
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            _edge(F.coalesce(F.get(F.col("_words"), i - 1), F.lit(""))).alias("left"),
            _edge(F.coalesce(F.get(F.col("_words"), i + 1), F.lit(""))).alias("right"),
        )

    return docs.withColumn("_own", own).withColumn("strings", F.transform("_places", placed)).drop("_words", "_places", "_own")


def _totals(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """``word``, ``total``: how often each word that may become a pattern occurs in all texts.

    Words beside fewer different strings than a pattern needs can't. Few words are sent to the tasks,
    which then count nothing else; many are joined after all words are counted.
    """
    needed = edges.groupBy("word").agg(F.count_distinct("value").alias("n")).where(F.col("n") >= MIN_SUPPORT)
    needed = staged(needed.select("word"), "words")
    words = docs.select(F.explode(F.transform(words_of("text"), _edge)).alias("word"))
    if needed.count() <= SENT_WORDS:
        return words.join(F.broadcast(needed), "word").groupBy("word").agg(F.count("*").alias("total"))
    return words.groupBy("word").agg(F.count("*").alias("total")).join(needed, "word", "left_semi")


def discovered(seen: DataFrame, docs: DataFrame) -> DataFrame:
    """``value`` of strings that high-confidence patterns find.

    ``seen`` has ``base`` and ``strings`` of every text. The graph has an edge for each string and each
    word beside it; a pattern's confidence is the sum of its strings' scores over all places at which its
    word occurs in the corpus, a candidate's score the chance that at least one pattern is right. Seeds
    keep the score 1.
    """
    strings = seen.where(F.size("strings") > 0).select("base", F.explode("strings").alias("x")).select(
        "x.*", F.exists("base", lambda b: (b["start"] < F.col("x.end")) & (b["end"] > F.col("x.start"))).alias("seed")
    )
    sides = F.array(F.struct(F.lit("L").alias("side"), F.col("left").alias("word")), F.struct(F.lit("R").alias("side"), F.col("right").alias("word")))
    edges = (
        strings.withColumn("s", F.explode(sides))
        .select("value", "seed", "s.side", "s.word")
        .where("word <> ''")
        .groupBy("value", "side", "word")
        .agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    )
    edges = staged(edges, "edges")
    weighed = edges.join(staged(_totals(docs, edges), "totals"), "word")
    found = edges.groupBy("value").agg(F.max("seed").alias("seed")).select("value", F.col("seed").cast("double").alias("score"))
    for _ in range(ROUNDS):
        patterns = (
            weighed.join(found, "value")
            .groupBy("side", "word")
            .agg(
                (F.sum(F.col("n") * F.col("score")) / (F.first("total") + PRIOR)).alias("confidence"),
                F.sum((F.col("score") >= MIN_CONFIDENCE).cast("int")).alias("support"),
            )
            .where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("support") >= MIN_SUPPORT))
        )
        right = F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(1 - 1e-6))
        doubt = F.sum(F.log(1 - right))
        found = staged(
            edges.join(patterns, ["side", "word"], "left")
            .groupBy("value")
            .agg(F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(doubt)).alias("score"), F.max("seed").alias("seed")),
            "scores",
        )
    return found.where((F.col("score") >= MIN_CONFIDENCE) & ~F.col("seed")).select("value")


def found(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (kind, start, end), in code points, of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. ``base`` holds the fixed shapes;
    ``spans`` also the kind ``context``: strings that no shape covers and that the bootstrapped
    patterns take for identifiers, wherever they occur. A null text is empty and has none. Repeated rows
    have the same result each, null ids are kept, an empty table gives an empty one.
    """
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    seen = staged(with_strings(with_base(with_row_key(plain, ["doc_id", "text"]))).drop("text"), "spans")
    free = (
        seen.where(F.size("strings") > 0)
        .dropDuplicates(["_a", "_b"])
        .select("_a", "_b", "base", F.explode("strings").alias("x"))
        .where(~F.exists("base", lambda b: (b["start"] < F.col("x.end")) & (b["end"] > F.col("x.start"))))
        .select("_a", "_b", F.col("x.value").alias("value"), F.struct(F.lit("context").alias("kind"), F.col("x.start").alias("start"), F.col("x.end").alias("end")).alias("span"))
    )
    more = free.join(discovered(seen, plain), "value").groupBy("_a", "_b").agg(F.collect_list("span").alias("more"))
    both = F.array_sort(
        F.transform(
            F.concat("base", F.coalesce("more", F.array().cast(_NO_SPANS))),
            lambda x: F.struct(x["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"]).alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")),
        )
    )
    return seen.join(more, ["_a", "_b"], "left").select(
        "doc_id",
        "base",
        F.transform(both, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"),
    )


def digest(rows: DataFrame) -> DataFrame:
    """The counts and the hash of the base spans, and all spans as text."""

    def written(spans: str) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *[number(kind) for kind in _SHAPES], F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans")
    )
