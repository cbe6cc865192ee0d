"""Quality rules, above all cross-document line frequency: lines that too many documents of a host
share are removed, documents of which too little is left are rejected. Columns only, no Python code
on the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import NOT_SPACE, SPACE, staged, whole_row, with_row_key, words_of

WINDOW = 8
#: A line is removed if more different documents of its host hold it.
MAX_DOCUMENTS = 20
#: A document is rejected if less than this share of its words is left.
MIN_LEFT_PERCENT = 30
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def repeated_words(hashes: Column | str, window: int = WINDOW) -> Column:
    """Number of words that lie in a window of ``window`` words found twice or more in the text.

    ``hashes`` has one hash for each word. Only texts in which some window comes again are sorted.
    """
    hashes = F.col(hashes) if isinstance(hashes, str) else hashes
    return F.when(F.size(hashes) < window + 1, F.lit(0)).otherwise(_repeats(_windows(hashes, window), window)).cast("long")


def _windows(hashes: Column, window: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(hashes) - (window - 1))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(window))))


def _repeats(windows: Column, window: int) -> Column:
    def measured(rows: Column) -> Column:
        """rows: (hash, position), sorted."""

        def again(row: Column, k: Column) -> Column:
            before, after = F.get(rows, k - 1)["h"], F.get(rows, k + 1)["h"]
            return F.coalesce(row["h"] == before, F.lit(False)) | F.coalesce(row["h"] == after, F.lit(False))

        places = F.array_sort(F.transform(F.filter(rows, again), lambda r: r["p"]))
        return covered(places)

    def covered(places: Column) -> Column:
        reach = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(
            places,
            reach,
            lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(window))).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    def once(array: Column) -> Column:
        """The result for an array that is evaluated once: lambdas bind it to a name."""
        rows = F.array_sort(F.transform(array, lambda h, k: F.struct(h.alias("h"), k.alias("p"))))
        bound = F.transform(F.array(rows), measured)
        return F.when(F.size(F.array_distinct(array)) == F.size(array), F.lit(0)).otherwise(F.get(bound, F.lit(0)))

    return F.get(F.transform(F.array(windows), once), F.lit(0))


def normalised(line: Column) -> Column:
    """A line without regard to A-Z case and to white space."""
    return F.translate(F.trim(F.regexp_replace(line, SPACE, " ")), _UPPER, _LOWER)


def line_key(line: Column) -> Column:
    """64 bits of the MD5 of the normalised line, in hex."""
    return F.substring(F.md5(normalised(line)), 1, 16)


def measured(docs: DataFrame) -> DataFrame:
    """Add what one text shows by itself: the counts, ``base_failed``, and ``_lines``: its lines with
    a word, as (key, words)."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(NOT_SPACE))
    return (
        docs.withColumn("_w", words_of("text"))
        .withColumn("_raw", lines)
        .withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
        .withColumn(
            "n_symbols",
            F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^#*$%&|<>]+", "")).cast("long"),
        )
        .withColumn("n_dup_lines", (F.size("_raw") - F.size(F.array_distinct("_raw"))).cast("long"))
        .withColumn("n_repeat_words", repeated_words("_h"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumn(
            "_lines",
            F.transform("_raw", lambda x: F.struct(line_key(x).alias("key"), F.size(words_of(x)).alias("words"))),
        )
        .drop("_w", "_raw", "_h")
    )


def frequent_lines(lined: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``host``, ``key`` of lines that more than ``max_documents`` different documents of a host hold.

    ``lined`` has ``host`` and ``_lines``. Documents with the same set of normalised lines are one
    document, so a text with a thousand copies loses nothing; all others count apart, also those that
    differ in a single line. The pairs of line and document are made distinct before they are counted
    by line, so a line in every document of a host is spread over all tasks.
    """
    keys = F.array_distinct(F.transform("_lines", lambda x: x["key"]))
    lines = (
        lined.select("host", keys.alias("keys"))
        .select("host", "keys", F.xxhash64(F.array_sort("keys")).alias("document"))
        .select("host", F.explode("keys").alias("key"), "document")
    )
    return (
        lines.groupBy("host", "key")
        .agg(F.count_distinct("document").alias("documents"))
        .where(F.col("documents") > max_documents)
        .select("host", "key")
    )


def verdicts(
    docs: DataFrame,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` without ``text``, with counts, ``base_failed``, ``kept`` and ``removed``.

    ``docs`` needs ``doc_id``, ``text`` and the ``host`` column; its other columns don't matter and
    are not returned. A null text has no words and fails the base rules; null hosts are one host, as
    is the empty name. ``removed`` holds the keys of the document's lines that are too frequent at
    its host; ``kept`` is false if the base rules fail or less than ``min_left_percent`` of the words
    are left without them. Repeated rows have the same result each; an empty table gives an empty
    one.
    """
    named = docs.select("doc_id", "text", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    seen = staged(measured(with_row_key(named, ["doc_id", "host", "text"])).drop("text"), "lines")
    lines = seen.dropDuplicates(["_a", "_b"]).select("_a", "_b", "host", F.explode("_lines").alias("x"))
    cut = (
        lines.select("_a", "_b", "host", "x.*")
        .join(frequent_lines(seen, max_documents), ["host", "key"])
        .groupBy("_a", "_b")
        .agg(F.sum("words").alias("n_removed"), F.collect_set("key").alias("removed"))
    )
    left = 100 * (F.col("n_words") - F.col("n_removed")) >= min_left_percent * F.col("n_words")
    return (
        seen.drop("_lines")
        .join(cut, ["_a", "_b"], "left")
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
        .withColumn("removed", F.coalesce("removed", F.array().cast("array<string>")))
        .withColumn("kept", ~F.col("base_failed") & left)
    )


def cleaned(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """The documents that pass :func:`verdicts`, without the lines that are too frequent.

    All columns are returned; ``text`` and, where there is one, ``n_chars`` are changed for documents
    that lose lines.
    """
    named = docs.select(whole_row(docs), "doc_id", "text", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"))
    keyed = with_row_key(named, ["doc_id", "_host", "text"])
    passed = verdicts(docs, host, **limits).where("kept").select("_a", "_b", F.col("removed").alias("_cut"))
    left = F.array_join(
        F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col("_cut"), line_key(x))), "\n"
    )
    changed = {"text": F.when(F.size("_cut") > 0, left).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.when(F.size("_cut") > 0, F.length(left)).otherwise(F.col("_row.n_chars"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    out = keyed.join(passed.dropDuplicates(["_a", "_b"]), ["_a", "_b"])
    return out.select("_row", *[c.alias(f"_new_{name}") for name, c in changed.items()]).select(
        *[F.col(f"_new_{c}").alias(c) if c in changed else F.col("_row").getField(c).alias(c) for c in docs.columns]
    )
