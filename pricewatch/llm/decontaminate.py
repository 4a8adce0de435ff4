"""Benchmark decontamination: test windows as a hash set, exact hits, spans or documents removed.

Built of DataFrame functions only. A window is `size` consecutive words of a
test item, or a whole shorter item. Documents are scanned once. Any window of
13 words holds a run of six that starts at a multiple of eight, so only every
eighth position is looked up in the set of test runs; the few that match are
opened into the eight windows which can hold them, and those are compared word
for word. Shorter items are looked up at every position.

Test runs are broadcast only if their count is below `broadcast_rows`; a larger
benchmark is joined by shuffling rows that carry 20 words each.

Nulls: null or empty texts have no words and no hits. Ties and repeated rows
keep their rows, each with the same result. Items with a null id count as one
item whose id reads "". An empty benchmark hits nothing. Other columns of the
inputs are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_ascii, shielded

#: Everything that is neither a digit, a lower-case letter nor beyond ASCII.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
REST = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+$"


def item_words(text: Column) -> Column:
    """Lower-case words of digits, letters and characters beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def _run_hash(words: Column, at: Column, length: int) -> Column:
    """Hash of `length` words from position `at` (from 0); single elements, as a slice would copy the text each time."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(length)])


def _starts(n: Column, length: int, step: int = 1, run: int | None = None) -> Column:
    """Positions at which runs are looked up: none if the text is too short."""
    last = n - F.lit(run or length)
    empty = F.array().cast("array<int>")
    return F.when(n >= length, F.sequence(F.lit(0), last, F.lit(step))).otherwise(empty)


def _grid(size: int) -> tuple[int, int]:
    """Run length and step: every window holds a whole run that starts on the grid."""
    run = (size + 1) // 2 - (1 if size > 2 else 0)
    return max(run, 1), size - max(run, 1) + 1


def test_windows(tests: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """One row per distinct window: length, words joined by blanks, the items that hold it, in order."""
    items = tests.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_item"), item_words(F.col(text_col)).alias("_words")
    ).withColumn("_n", F.size("_words")).where("_n > 0")
    length = F.least(F.col("_n"), F.lit(size))
    spans = items.select(
        "_item", "_words", length.alias("len"), F.explode(F.sequence(F.lit(1), F.col("_n") - length + 1)).alias("_at")
    )
    window = F.array_join(F.slice("_words", F.col("_at"), F.col("len")), " ")
    return spans.select("_item", "len", window.alias("window")).groupBy("len", "window").agg(
        F.array_sort(F.collect_set("_item")).alias("items")
    )


def find_hits(
    docs: DataFrame,
    tests: DataFrame,
    size: int = 13,
    doc_id: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, spans (start and length of each hit window), n_hit, items."""
    run, step = _grid(size)
    windows = test_windows(tests, item_id, item_text, size)
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())
    cut = F.split("window", " ")
    whole = F.coalesce(*[F.when(F.col("len") == n, _run_hash(cut, F.lit(0), n)) for n in lengths if n < size], F.lit(0).cast("long"))
    runs = windows.select(
        "len",
        F.explode(
            F.when(
                F.col("len") == size,
                F.transform(F.sequence(F.lit(0), F.lit(step - 1)), lambda i: _run_hash(cut, i, run)),
            ).otherwise(F.array(whole))
        ).alias("hash"),
    ).distinct()
    small = windows.count() * (step + 1) <= broadcast_rows
    hint = F.broadcast if small else (lambda df: df)

    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        item_words(F.col(text_col)).alias("_words"),
    ).withColumn("_n", F.size("_words"))

    def looked_up(length: int) -> Column:
        full = length == size
        return F.transform(
            _starts(F.col("_n"), length, step if full else 1, run if full else length),
            lambda i: F.struct(
                F.lit(length).alias("len"),
                i.alias("pos"),
                _run_hash(F.col("_words"), i, run if full else length).alias("hash"),
            ),
        )

    # explode_outer, as explode would add a filter on the array's size that computes all of it a second time.
    # The words that a window around the run can hold.
    around = F.greatest(F.col("_run.pos") - (step - 1), F.lit(0))
    near = F.array(*[F.get(F.col("_words"), around + k) for k in range(size + step - 1)])
    # The first element stands for the document itself, so that one without hits keeps its row.
    itself = F.array(F.struct(F.lit(0).alias("len"), F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("hash")))
    found = (
        rows.withColumn("_runs", F.concat(itself, *[looked_up(n) for n in lengths]))
        .select("doc_id", "text_key", "_n", "_words", F.explode_outer("_runs").alias("_run"))
        .select(
            "doc_id",
            "text_key",
            "_n",
            F.col("_run.len").alias("len"),
            F.col("_run.hash").alias("hash"),
            around.alias("_from"),
            F.col("_run.pos").alias("_pos"),
            near.alias("_near"),
        )
        .join(hint(runs.withColumn("_is", F.lit(True))), ["len", "hash"], "left")
        .where("len = 0 or _is")
    )
    first = F.when(F.col("len") == size, F.col("_from")).otherwise(F.col("_pos"))
    last = F.when(F.col("len") == size, F.least(F.col("_pos"), F.col("_n") - size)).otherwise(F.col("_pos"))
    opened = (
        found.withColumn("_at", F.explode(F.when(F.col("len") == 0, F.array(F.lit(-1))).otherwise(F.sequence(first, last))))
        .withColumn(
            "window",
            F.when(F.col("len") > 0, F.array_join(F.slice("_near", F.col("_at") - F.col("_from") + 1, F.greatest("len", F.lit(1))), " ")),
        )
        .select("doc_id", "text_key", "_n", "len", "_at", "window")
        .join(hint(windows), ["len", "window"], "left")
        .where("len = 0 or items is not null")
    )
    hit = F.when(F.col("len") > 0, F.struct(F.col("_at").alias("start"), F.col("len").alias("len")))
    per_text = opened.groupBy("doc_id", "text_key").agg(
        F.max("_n").cast("long").alias("n_words"),
        F.count(F.when(F.col("len") == 0, True)).alias("_rows"),
        F.array_sort(F.collect_set(hit)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # Equal rows met in one group; each gets its row back.
    return per_text.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows")))).select(
        "doc_id", "text_key", "n_words", "spans", covered(F.col("spans")).alias("n_hit"), "items"
    )


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans, each once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["len"]
        more = F.greatest(end - F.greatest(s["start"], acc["end"]), F.lit(0))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def contaminated(n_hit: Column, n_words: Column, one_in: int = 20) -> Column:
    """The hit words are at least one in `one_in`."""
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def without_spans(text: Column, spans: Column) -> Column:
    """The text less the hit words, each with the gap before it; the rest stays as it was."""
    pieces = F.concat(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), F.regexp_extract_all(text, F.lit(REST), F.lit(0)))
    outside = lambda i: ~F.exists(spans, lambda s: (i >= s["start"]) & (i < s["start"] + s["len"]))
    return F.array_join(F.transform(pieces, lambda p, i: F.when(outside(i), p)), "")


@shielded
def decontaminate(
    docs: DataFrame, tests: DataFrame, remove: str = "documents", one_in: int = 20, doc_id: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """`docs` with its own columns: less the contaminated documents, or with the hit spans cut out of all texts.

    The flags are joined back by id and text, null-safe; repeated rows are flagged once.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove documents or spans")
    hits = find_hits(docs, tests, doc_id=doc_id, text_col=text_col, **options).where("n_hit > 0")
    flags = hits.dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("_flag_id"),
        F.col("text_key").alias("_flag_key"),
        contaminated(F.col("n_hit"), F.col("n_words"), one_in).alias("_flag_is"),
        F.col("spans").alias("_flag_spans"),
    )
    same = docs[doc_id].eqNullSafe(F.col("_flag_id")) & (F.xxhash64(docs[text_col]) == F.col("_flag_key"))
    if remove == "documents":
        return docs.join(flags.where("_flag_is"), same, "left_anti")
    joined = docs.join(flags, same, "left")
    text = F.when(F.col("_flag_spans").isNull(), docs[text_col]).otherwise(without_spans(docs[text_col], F.col("_flag_spans")))
    return joined.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])
