"""Benchmark decontamination: a prefix-filtered join of the shingles of benchmark items with those of documents.

All steps are DataFrame expressions. Every run of SHINGLE words in a document that is some item's shingle is found by
a join on the words themselves, so a match is exact. A window of an item (WINDOW words) can only occur where its
rarest shingle does; there the length and position bounds are applied, and the window occurs if the shingles at its
begin and its end, which cover it, stand at their places too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import BROADCAST_ROWS, hint_if_counted, stored

# A word is a run of ASCII digits, letters and code points beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WINDOW, SHINGLE = 10, 5

# Shingles of all items travel to every task if they are at most this many rows and bytes; beyond, rows are shuffled.
BROADCAST_BYTES = 64 << 20


def item_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case and no other letter changed; none for a null.

    Spark's own lower() is right for texts, or words, of ASCII alone; only words with other letters need translate(),
    which looks up each character.
    """
    plain = lambda c: F.octet_length(c) == F.char_length(c)
    one = lambda w: F.when(plain(w), F.lower(w)).otherwise(F.translate(w, A_Z, A_Z.lower()))
    cut = lambda c: F.split(c, SEPARATORS)
    text = F.coalesce(text, F.lit(""))
    # Before the split other letters are separators only if they are not ASCII letters: case does not matter to the cut.
    either = SEPARATORS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    told = F.when(plain(text), cut(F.lower(text))).otherwise(F.transform(F.split(text, either), one))
    return F.array_remove(told, "")


def shingle(words: Column, at: Column, size: int) -> Column:
    """The ``size`` words from place ``at`` (0-based) on, by single blanks; null where there are not so many."""
    each = [F.get(words, at + k) for k in range(size)]
    return F.when(at + size <= F.size(words), F.concat_ws(" ", *each))


def _lengths(window: int, size: int) -> Column:
    """Length of an item's windows, and of the shingles that its windows are made of."""
    own = F.least(F.col("n_words"), F.lit(window))
    return F.struct(own.cast("int").alias("window"), F.least(own, F.lit(size)).cast("int").alias("shingle"))


def _shingled(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Each place of each row with its shingles: the input's columns, ``at``, ``size``, ``shingle``.

    Behind the last word comes one place more, whose shingle is null: it stands for the row itself. The words are only
    referred to, never copied to a row that is shuffled.
    """
    places = rows.select("*", F.posexplode(F.concat("words", F.array(F.lit(None).cast("string")))).alias("at", "word"))
    if len(sizes) == 1:
        return places.select("*", F.lit(sizes[0]).alias("size"), shingle(F.col("words"), F.col("at"), sizes[0]).alias("shingle"))
    made = F.array(*[F.struct(F.lit(s).alias("size"), shingle(F.col("words"), F.col("at"), s).alias("shingle")) for s in sizes])
    return places.select("*", F.inline(made))


def _items(benchmark: DataFrame, window: int, size: int, key: str, text: str) -> DataFrame:
    """``(item_id, row, words, n_words, lengths)`` of the items that have words."""
    items = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item_id"), item_words(F.col(text)).alias("words"))
    items = items.withColumn("n_words", F.size("words")).where("n_words > 0")
    return stored(items.withColumns({"row": F.monotonically_increasing_id(), "lengths": _lengths(window, size)}), "items")


def _windows(places: DataFrame) -> DataFrame:
    """``(row, item_id, window, shingle_size, start, id, off)``: each window of each item once for each of its shingles.

    A shingle at place p belongs to the windows that begin at p - off, as far as they lie within the item.
    """
    off = F.explode(F.sequence(F.lit(0), F.col("lengths.window") - F.col("lengths.shingle"))).alias("off")
    told = places.select("row", "item_id", "n_words", "lengths", "at", "id", off)
    told = told.withColumn("start", F.col("at") - F.col("off")).where("start >= 0 AND start + lengths.window <= n_words")
    return told.select("row", "item_id", F.col("lengths.window").alias("window"), F.col("lengths.shingle").alias("size"), "start", "id", "off")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    size: int = SHINGLE,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per row of ``docs``.

    A window is ``window`` consecutive words of an item, or all of an item with fewer; n_hit counts the words of a
    document inside any occurrence of a window, n_items the distinct items (by id) with a window that occurs, and
    items_sha256 digests their ids, sorted as texts and joined by commas. ``2 * size`` must be at least ``window``.

    Documents are read once and never shuffled: only places where a shingle of some item stands go on, as numbers.
    Windows of equal words, in whatever items, are one. Every join that follows is on (document, place) or has the
    counted windows on its other side, so a passage that a third of all documents hold is spread by document.

    A null text has no words; neither has an item without text, which is nowhere. A null item id counts as an empty
    one. Rows that repeat an id are told apart. No documents give no rows; no items, rows without a hit.
    """
    if 2 * size < window:
        raise ValueError("two shingles must cover a window")
    items = _items(benchmark, window, size, item_key, item_text)
    sizes = sorted(r[0] for r in items.select("lengths.shingle").distinct().collect()) or [size]  # at most `size` numbers
    places = _shingled(items, sizes).where("shingle IS NOT NULL AND size = lengths.shingle")
    known = stored(places.select("shingle").distinct().withColumn("id", F.monotonically_increasing_id()), "item-shingles")
    n, size_bytes = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("shingle")), F.lit(0))).first()
    told = known if size_bytes > BROADCAST_BYTES else hint_if_counted(known, n)

    # The one pass over the documents: places of item shingles, and a last row (id null) that tells the word count.
    rows = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("doc"), item_words(F.col(text)).alias("words"))
    here = _shingled(rows, sizes).select("doc_id", "doc", "at", "size", "shingle", (F.size("words") == F.col("at")).alias("last"))
    here = here.where(F.col("shingle").isNotNull() | (F.col("last") & (F.col("size") == sizes[0])))
    found = here.join(told, "shingle", "left").where("id IS NOT NULL OR last").select("doc_id", "doc", "at", "id", "last")
    found = stored(found, "found")
    matches = found.where("id IS NOT NULL").select("doc", "at", "id")

    # Rarity of each shingle: how often the documents hold it. Windows with one that they never hold are nowhere.
    counts = stored(matches.groupBy("id").agg(F.count("*").alias("n")), "rarity")
    own = stored(_windows(places.join(known, "shingle")), "window-shingles")
    n_shingles = counts.count()
    rated = own.join(hint_if_counted(counts, n_shingles), "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = F.min(F.struct("n", "id", "off")).alias("rarest")
    ends = [F.max(F.when(F.col("off") == o, F.col("id"))).alias(c) for c, o in (("first", F.lit(0)), ("final", F.col("window") - F.col("size")))]
    whole = rated.groupBy("row", "item_id", "window", "size", "start").agg(rarest, *ends).where("rarest.n > 0")
    whole = stored(whole.select("item_id", "window", "size", "first", "final", "rarest"), "windows")
    # The shingles at both ends cover a window: windows that share them are the same words.
    same = ["window", "size", "first", "final"]
    prefix = stored(whole.groupBy(*same).agg(F.min("rarest").alias("rarest")).withColumn("window_id", F.monotonically_increasing_id()), "prefixes")
    n_windows = prefix.count()

    # Candidates: where the rarest shingle stands and the window has room before and behind it.
    bounds = found.where("last").select("doc", F.col("at").alias("n_words"))
    near = matches.alias("m").join(hint_if_counted(prefix, n_windows).alias("p"), F.col("m.id") == F.col("p.rarest.id"))
    near = near.select("doc", (F.col("at") - F.col("rarest.off")).alias("start"), "window_id", *same).where("start >= 0")
    near = near.join(bounds.hint("merge"), "doc").where("start + window <= n_words").drop("n_words")
    # Verified: both covering shingles stand at their places.
    for end, at in (("first", F.col("start")), ("final", F.col("start") + F.col("window") - F.col("size"))):
        stands = matches.select(F.col("doc").alias("_doc"), F.col("at").alias("_at"), F.col("id").alias("_id")).hint("merge")
        near = near.join(stands, (F.col("doc") == F.col("_doc")) & (at == F.col("_at")) & (F.col(end) == F.col("_id")), "left_semi")
    occurs = stored(near.select("doc", "start", "window", "window_id"), "occurrences")

    # Words inside any occurrence, each once: what an occurrence adds beyond the furthest end before it.
    spans = occurs.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("window")).alias("end"))
    before = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    added = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    hits = spans.withColumn("added", added).groupBy("doc").agg(F.sum("added").alias("n_hit"))

    held = whole.select("item_id", *same).distinct().join(prefix.select("window_id", *same), same).select("item_id", "window_id").distinct()
    held = stored(held, "window-items")
    pairs = occurs.select("doc", "window_id").distinct().join(hint_if_counted(held, held.count(), BROADCAST_ROWS), "window_id")
    listed = pairs.select("doc", "item_id").distinct().groupBy("doc").agg(F.sort_array(F.collect_list("item_id")).alias("items"))

    ended = found.where("last").select("doc_id", "doc", F.col("at").cast("long").alias("n_words"))
    out = ended.join(hits.hint("merge"), "doc", "left").join(listed.hint("merge"), "doc", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
