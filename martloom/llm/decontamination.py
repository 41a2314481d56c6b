"""Benchmark decontamination by templates: finds items also with other numbers, names and units.

A text becomes a row of lower-case words in which numbers, names and units are typed placeholders.
Windows of this template are joined by hash with the windows of the benchmark items. Windows that
lie on one diagonal of a text and an item are then held against each other slot by slot: the same
value of the item must stand for the same value of the text, in nearly all slots of the diagonal.
Windows of mostly placeholders are joined by their very words, and a long run of windows counts
whatever its share of the item, with equal words also where the slots disagree.

A window that many templates share (a lead-in, a form of question) never finds an item: it is
joined with the texts once, not once per item, and counts only for items of which the text holds a
window of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import framed, small_side, stored, unframed, whole_text

WINDOW = 8
# The share of an item's windows that must be found.
MIN_SHARE_PERCENT = 30
# The share of a diagonal's slots in which an item's value stands for its most usual text value.
AGREE_PERCENT = 80
# So many words in a row are contamination, however long the item is.
RUN_WORDS = 15
# A window in more different templates than this is common; it tells nothing of any of its items.
MAX_TEMPLATES = 10

# A number, a word, or the end of a sentence.
_TOKEN = r"[0-9]+(?:[.,:][0-9]+)*|[\p{L}][\p{L}\p{M}\p{N}]*|[.!?\n]"
_ENDS = (".", "!", "?", "\n")
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion dozen"
).split()
UNITS = (
    "mm cm km kg mg ml km2 meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
    "foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week "
    "weeks month months year years dollar dollars cent cents euro euros percent degree degrees"
).split()


def with_template(rows: DataFrame) -> DataFrame:
    """Adds raw (the words and numbers of ``_text``) and template (the same with placeholders)."""
    found = rows.withColumn("_found", F.regexp_extract_all("_text", F.lit(_TOKEN), F.lit(0)))

    def word(token: Column, i: Column) -> Column:
        low = F.lower(token)
        before = F.when(i > 0, F.get("_found", i - 1)).otherwise(".")
        # A capital followed by small letters, but not where a sentence starts.
        name = (
            (F.substring(token, 1, 1) != F.substring(low, 1, 1))
            & (token != F.upper(token))
            & ~before.isin(*_ENDS)
        )
        return F.struct(
            token.alias("raw"),
            F.when(token.between("0", "9~") | low.isin(*NUMBER_WORDS), "<number>")
            .when(name, "<name>")
            .when(low.isin(*UNITS), "<unit>")
            .otherwise(low)
            .alias("template"),
        )

    words = F.filter(F.transform("_found", word), lambda w: ~w["raw"].isin(*_ENDS))
    parted = found.withColumn("_parted", words)
    return parted.select(
        *rows.columns, F.col("_parted.raw").alias("raw"), F.col("_parted.template").alias("template")
    )


def word_hashes(template: str, raw: str) -> dict[str, Column]:
    """Hashes of the template's words, and of the raw ones, which never equal the former."""
    return {
        "_hashes": F.transform(template, lambda t: F.xxhash64(t)),
        "_raws": F.transform(raw, lambda r: F.xxhash64(F.lit("raw"), F.lower(r))),
    }


def window_at(start: Column, length: Column | int, hashes: str = "_hashes") -> Column:
    """Hash of the window that starts at the place (from 1)."""
    return F.xxhash64(F.slice(hashes, start, length))


def windows_of(places: Column, length: int, hashes: str) -> Column:
    return F.transform(
        places, lambda i: F.struct(i.alias("_at"), window_at(i, length, hashes).alias("window"))
    )


def is_slot(word: Column) -> Column:
    return word.startswith("<")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per window of each item: item_id, form, length, n_windows, n_told, place, exact,
    window, raw, template.

    form is the hash of the item's template. Items shorter than a window are one window of their own
    length. Windows in which placeholders outnumber the other words say little and are exact: they
    are found by their raw words, numbers included. n_told counts the others. Null texts have no
    windows; a null item_id stays, repeated items count once.
    """
    rows = benchmark.select(benchmark["item_id"].cast("long"), whole_text().alias("_text")).distinct()
    tokens = stored(with_template(rows)).where(F.size("template") > 0)
    tokens = tokens.withColumns(
        {**word_hashes("template", "raw"), "length": F.least(F.size("template"), F.lit(window))}
    )

    def window_of(i: Column) -> Column:
        template = F.slice("template", i, F.col("length"))
        exact = F.size(F.filter(template, is_slot)) * 2 > F.col("length")
        return F.struct(
            i.alias("place"),
            exact.alias("exact"),
            F.when(exact, window_at(i, F.col("length"), "_raws"))
            .otherwise(window_at(i, F.col("length")))
            .alias("window"),
            F.slice("raw", i, F.col("length")).alias("raw"),
            template.alias("template"),
        )

    places = F.sequence(F.lit(1), F.size("template") - F.col("length") + 1)
    listed = tokens.select(
        "item_id", F.xxhash64("template").alias("form"), "length",
        F.transform(places, window_of).alias("windows"),
    )
    return listed.select(
        "item_id",
        "form",
        "length",
        F.size("windows").alias("n_windows"),
        F.size(F.filter("windows", lambda w: ~w["exact"])).alias("n_told"),
        F.inline("windows"),
    )


def weighed(items: DataFrame) -> DataFrame:
    """Adds tell (the window may find its item), n_tell and n_told_tell (the item's such windows, and
    those of them that are not exact).

    A window tells its item if at most MAX_TEMPLATES templates hold it; where none of a template's
    windows is that rare, its rarest ones tell it, so that every item can be found.
    """
    forms = items.select("form", "exact", "window").distinct()
    spread = forms.groupBy("exact", "window").agg(F.count("*").alias("n_forms"))
    rarest = forms.join(spread, ["exact", "window"]).groupBy("form").agg(F.min("n_forms").alias("rarest"))
    told = items.join(spread, ["exact", "window"]).join(rarest, "form")
    tell = F.col("n_forms") <= F.greatest("rarest", F.lit(MAX_TEMPLATES))
    # One item's windows.
    item = Window.partitionBy("item_id", "form")
    return (
        told.withColumn("tell", tell)
        .withColumns(
            {
                "n_tell": F.sum(F.col("tell").cast("int")).over(item),
                "n_told_tell": F.sum((F.col("tell") & ~F.col("exact")).cast("int")).over(item),
            }
        )
        .drop("n_forms", "rarest")
    )


def met_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows of the texts that are also the benchmark's: text_hash, item_id, place (in the item),
    exact, diagonal, common. Copies count once.

    Common windows come once, not once per item: with the window, the place in the text as diagonal,
    and no item. ``docs`` has text_hash and _text. Only hashes and places leave a text's row; with a
    small benchmark they are looked up where they arise, else both sides are shuffled by the hash.
    """
    sizes = items.groupBy("length").agg(F.max("exact").alias("exact")).orderBy("length").collect()
    telling = items.where("tell").select(
        "item_id", "length", "place", "exact", "window", F.lit(None).cast("long").alias("common")
    )
    common = items.where(~F.col("tell")).select("length", "exact", "window").distinct()
    common = common.select(
        F.lit(None).cast("long").alias("item_id"), "length", F.lit(0).alias("place"), "exact", "window",
        F.col("window").alias("common"),
    )
    keys = stored(telling.unionByName(common))
    found = None
    hashed = with_template(docs).select(
        "text_hash", *[c.alias(name) for name, c in word_hashes("template", "raw").items()]
    )
    for length, exact in sizes:
        places = F.sequence(F.lit(1), F.size("_hashes") - (length - 1))
        # Raw windows are hashed only if the benchmark has any to look up.
        kinds = [
            windows_of(places, length, hashes)
            for hashes in (["_hashes", "_raws"] if exact else ["_hashes"])
        ]
        # No filter on the size: it would be pushed down and compute all templates twice.
        windows = F.when(F.size("_hashes") >= length, F.concat(*kinds))
        rows = hashed.select("text_hash", F.inline(windows))
        side = small_side(keys.where(F.col("length") == length).drop("length"))
        met = rows.join(side, "window").select(
            "text_hash", "item_id", "place", "exact", (F.col("_at") - F.col("place")).alias("diagonal"),
            "common",
        )
        found = met if found is None else found.union(met)
    if found is None:
        empty = "text_hash long, item_id long, place int, exact boolean, diagonal int, common long"
        return docs.sparkSession.createDataFrame([], empty)
    return found.distinct()


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Equal windows: text_hash, item_id, place (in the item), exact, diagonal, tell.

    Common windows only of items that have a telling one in the same text: they grow with those
    pairs, not with all items that share the window.
    """
    met = stored(met_windows(docs, items))
    columns = ["text_hash", "item_id", "place", "exact", "diagonal"]
    telling = met.where(F.col("common").isNull()).select(*columns, F.lit(True).alias("tell"))
    pairs = telling.select("text_hash", F.col("item_id").alias("_item")).distinct()
    shared = items.where(~F.col("tell")).select("item_id", "place", "exact", F.col("window").alias("common"))
    asked = pairs.join(shared, F.col("_item").eqNullSafe(F.col("item_id"))).drop("_item")
    seen = met.where(F.col("common").isNotNull()).select("text_hash", "exact", "common", F.col("diagonal").alias("_at"))
    common = asked.join(seen, ["text_hash", "exact", "common"]).select(
        "text_hash", "item_id", "place", "exact", (F.col("_at") - F.col("place")).alias("diagonal"),
        F.lit(False).alias("tell"),
    )
    return telling.union(common.distinct())


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """text_hash, item_id, n_found, n_windows, n_slots of every text that holds an item.

    An item counts as held if its windows on diagonals with consistent slots make up at least
    MIN_SHARE_PERCENT percent of all its windows or of those that are not exact, and of those among
    them that tell it; or if RUN_WORDS words with a window that tells it follow each other on such a
    diagonal, or raw ones on any.
    """
    texts = docs.select(F.xxhash64(docs["text"]).alias("text_hash"), whole_text().alias("_text"))
    items = stored(weighed(stored(item_windows(benchmark, window))))
    found = stored(hits(texts, items))
    sizes = items.select("item_id", "n_windows", "n_told", "n_tell", "n_told_tell").distinct()
    told = F.when(~F.col("exact"), F.col("place"))
    places = [
        F.count_distinct("place").alias("n_found"),
        F.count_distinct(told).alias("n_told_found"),
        F.count_distinct(F.when(F.col("tell"), F.col("place"))).alias("n_tell_found"),
        F.count_distinct(F.when(F.col("tell"), told)).alias("n_told_tell_found"),
    ]

    def with_sizes(counted: DataFrame) -> DataFrame:
        same = F.col("item_id").eqNullSafe(F.col("_item"))
        return counted.join(sizes.withColumnRenamed("item_id", "_item"), same).drop("_item")

    def share(found: str, of: str) -> Column:
        return (F.col(of) > 0) & (F.col(found) * 100 >= F.col(of) * MIN_SHARE_PERCENT)

    enough = (share("n_found", "n_windows") & share("n_tell_found", "n_tell")) | (
        share("n_told_found", "n_told") & share("n_told_tell_found", "n_told_tell")
    )
    pair = ["text_hash", "item_id"]
    key = [*pair, "diagonal"]
    counted = found.groupBy(*pair).agg(*places)
    # Shorter items than a run are found by their share.
    runs = found.groupBy(*key).agg(F.count("*").alias("count"), F.max("tell").alias("tell"))
    runs = runs.where("tell").where(F.col("count") >= max(RUN_WORDS - window + 1, 1))
    likely = stored(with_sizes(counted).where(enough).select(*pair).union(runs.select(*pair)).distinct())
    likely_hits = found.alias("f").join(
        likely.alias("l"),
        (F.col("f.text_hash") == F.col("l.text_hash"))
        & F.col("f.item_id").eqNullSafe(F.col("l.item_id")),
        "left_semi",
    )
    # The slots of each hit, read from one copy of each text that is left.
    slots = likely_hits.join(
        items.select(
            F.col("item_id").alias("_item"), F.col("place").alias("_place"), "length",
            F.col("raw").alias("item_raw"), "template",
        ),
        F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("place") == F.col("_place")),
    )
    by_text = stored(
        slots.groupBy("text_hash").agg(
            F.collect_list(
                F.struct("item_id", "diagonal", "place", "exact", "tell", "length", "item_raw", "template")
            ).alias("hits")
        )
    )
    one_copy = (
        texts.join(small_side(by_text.select("text_hash")), "text_hash", "left_semi")
        .groupBy("text_hash").agg(F.first("_text").alias("_text"))
    )
    facing = with_template(one_copy).drop("template").join(by_text, "text_hash")

    def facing_words(h: Column) -> Column:
        own = F.slice("raw", h["place"] + h["diagonal"], h["length"])
        return F.transform(
            F.arrays_zip(h["item_raw"].alias("a"), own.alias("b"), h["template"].alias("kind")),
            lambda p, i: F.struct(
                p["kind"].alias("kind"),
                F.lower(p["a"]).alias("a"),
                F.lower(p["b"]).alias("b"),
                (h["place"] + i).alias("at"),
            ),
        )

    pairs = F.transform(
        "hits",
        lambda h: F.struct(
            h["item_id"].alias("item_id"),
            h["diagonal"].alias("diagonal"),
            h["place"].alias("place"),
            h["exact"].alias("exact"),
            h["tell"].alias("tell"),
            h["length"].alias("length"),
            F.forall(facing_words(h), lambda p: p["a"] == p["b"]).alias("equal"),
            F.filter(facing_words(h), lambda p: is_slot(p["kind"])).alias("slots"),
        ),
    )
    rows = stored(facing.select("text_hash", F.inline(pairs)))
    values = rows.select(*key, F.inline("slots"))
    usual = (
        values.groupBy(*key, "kind", "a", "b").agg(F.count_distinct("at").alias("n"))
        .groupBy(*key, "kind", "a").agg(F.max("n").alias("usual"), F.sum("n").alias("n"))
        .groupBy(*key).agg(F.sum("usual").alias("usual"), F.sum("n").alias("n"))
    )
    wrong = usual.where(F.col("usual") * 100 < F.col("n") * AGREE_PERCENT)
    wrong = wrong.select(*[F.col(k).alias(f"_{k}") for k in key], F.lit(True).alias("_wrong"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    judged = rows.join(wrong, on, "left").withColumn("consistent", F.col("_wrong").isNull())
    # Windows at places that follow each other have one difference of place and rank.
    ranked = judged.where("consistent or equal").withColumn(
        "run", F.col("place") - F.dense_rank().over(Window.partitionBy(*key).orderBy("place"))
    )
    run = Window.partitionBy(*key, "run")
    run_words = F.max("place").over(run) - F.min("place").over(run) + F.max("length").over(run)
    long_run = (run_words >= RUN_WORDS) & F.max("tell").over(run)
    right = ranked.withColumn("long_run", long_run).where("consistent or long_run")
    held = right.groupBy(*pair).agg(
        *places, F.max(F.size("slots")).alias("n_slots"), F.max("long_run").alias("long_run")
    )
    return with_sizes(held).where(enough | F.col("long_run")).select(
        "text_hash", "item_id", "n_found", "n_windows", "n_slots"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document and benchmark item that it holds, also re-parameterised.

    Output: doc_id, item_id, n_found (windows of the item found), n_windows, n_slots (most
    placeholders in a found window). Clean documents have no row. Null and empty texts hold
    nothing; null ids stay; repeated rows give repeated rows; other columns are ignored; an empty
    benchmark or table of documents gives no rows.
    """
    held = stored(contaminated_texts(docs, benchmark, window))
    rows = docs.select(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]).alias("text_hash"))
    return rows.join(small_side(held), "text_hash").drop("text_hash")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no benchmark item."""
    held = stored(contaminated_texts(docs, benchmark, window).select("text_hash").distinct())
    rows = framed(docs).withColumn("_hash", F.xxhash64("in_text"))
    side = small_side(held.withColumnRenamed("text_hash", "_held"))
    return unframed(rows.join(side, F.col("_hash") == F.col("_held"), "left_anti"), docs)
