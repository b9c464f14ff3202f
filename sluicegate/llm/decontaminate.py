"""Benchmark decontamination by template windows: numbers, names and units become typed slots, equal windows are joined by
hash, and a benchmark item counts as leaked if the values in its slots are replaced consistently.

Windows of mostly slots, and items shorter than a window, say too little as templates: these have to match word by word.

All of it is Spark SQL expressions. Repeated groups are possessive (``*+``): Java's stack holds each repetition of others, and
long runs of names or numbers overflow it. Nothing follows them, so matches are the same; else patterns use only what RE2 has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .base import stored

#: Words that count as units after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml cl l ms s sec secs min mins h hr hrs kb mb gb tb w kw mw v a hz khz mhz ghz j "
    "kj cal kcal second seconds minute minutes hour hours day days week weeks month months year years meter meters metre "
    "metres kilometer kilometers kilometre kilometres centimeter centimeters mile miles foot feet inch inches yard yards "
    "gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces liter liters litre litres gallon gallons "
    "degree degrees percent dollar dollars cent cents euro euros"
).split()
#: Marks before a slot's value; all are below any character of a word.
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
#: Capitalised words inside a sentence: after a word character or a comma and blanks, not after a sentence's end.
NAME_PATTERN = r"([\p{L}\p{N},;][ \t]+)(\p{Lu}[\p{Ll}'-]+(?:[ \t]\p{Lu}[\p{Ll}'-]+)*+)"
NUMBER_PATTERN = r"\p{N}+(?:[.,:/]\p{N}+)*+"
UNIT_PATTERN = rf"({NUMBER}[\p{{N}}.,:/]+)[ \t]*({'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))}|[%°])([^\p{{L}}\p{{N}}]|$)"
TOKEN_PATTERN = rf"{NAME}[\p{{L}}' \t-]+{NAME}|[{NUMBER}{UNIT}]?[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}\p{{M}}.,:/'-]*[\p{{L}}\p{{N}}\p{{M}}])?|{UNIT}[%°]"

#: Words of a window, and how many of them have to be plain words for its template to say anything.
WINDOW, PLAIN_WORDS = 8, 5
#: Words of the shortest item that is looked for; below a window's words an item is one window of its own.
SHORTEST = 4
#: Share of an item's words that consistent windows have to cover, or the words of one alignment that are enough in any item.
COVERAGE, RUN = 0.5, 25
#: Windows of a benchmark (about 100 bytes each) up to which they are broadcast; above, both sides are shuffled by hash.
BROADCAST_WINDOWS = 500_000
#: Characters above which a text is cut into overlapping spans.
SPAN = 1 << 18


def tokens(text: Column) -> Column:
    """Lower-case words of a text; slots start with their mark, followed by the value."""
    named = F.regexp_replace(F.coalesce(text, F.lit("")), F.lit(NAME_PATTERN), F.lit(f"$1{NAME}$2{NAME}"))
    numbered = F.regexp_replace(F.lower(named), F.lit(NUMBER_PATTERN), F.lit(f"{NUMBER}$0"))
    measured = F.regexp_replace(numbered, F.lit(UNIT_PATTERN), F.lit(f"$1 {UNIT}$2$3"))
    return F.regexp_extract_all(measured, F.lit(TOKEN_PATTERN), F.lit(0))


def spans(text: Column, width: int, overlap: int) -> Column:
    """Overlapping parts of a text, as ``span`` and its number ``part``. What is no longer than ``overlap`` lies whole in one."""
    step = width - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.length(text) - overlap - 1) / step), F.lit(0)).cast("int"))
    cut = F.transform(starts, lambda i: F.struct(i.alias("part"), F.substring(text, i * step + 1, F.lit(width)).alias("span")))
    whole = F.array(F.struct(F.lit(0).alias("part"), text.alias("span")))
    return F.inline_outer(F.when(F.length(text) > width, cut).otherwise(whole))


def hashes(template: Column, size: int) -> Column:
    """Hash of each window of ``size`` words; ``template`` has the hash of each word or slot."""
    last = F.size(template) - size
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(template, i + 1, size)))


def windows(rows: DataFrame, keys: list[str], at: str, sizes: list[int], among: DataFrame | None = None) -> DataFrame:
    """``keys`` and, per window of ``tokens``, its place ``at``, its ``width`` in words, its ``slots`` (values in order) and the
    ``key`` by which it meets others: the hash of its template, or of its very words if these are mostly slots or few.

    With ``among`` (``template``; at most ``BROADCAST_WINDOWS`` rows), only windows of these templates: what others hold is never
    spelled out.
    """
    template = F.transform("tokens", lambda t: F.xxhash64(F.when(t < "\x04", F.substring(t, 1, 1)).otherwise(t)))
    hashed = rows.select(*keys, "tokens", template.alias("words"))
    every = hashed.select(*keys, "tokens", F.concat(*[hashes(F.col("words"), n) for n in sizes]).alias("all"))
    # The outer form, as Spark infers a filter from the other that works out every window once more.
    one = every.select(*keys, "tokens", F.posexplode_outer("all").alias("place", "template")).filter("template IS NOT NULL")
    if among is not None:
        one = one.join(F.broadcast(among), "template", "left_semi")
    place, width = F.col("place"), F.lit(sizes[0])
    before = F.greatest(F.size("tokens") - (sizes[0] - 1), F.lit(0))
    for n in sizes[1:]:  # the windows of each size follow those of the sizes before
        place = F.when(F.col("place") >= before, F.col("place") - before).otherwise(place)
        width = F.when(F.col("place") >= before, n).otherwise(width)
        before = before + F.greatest(F.size("tokens") - (n - 1), F.lit(0))
    cut = one.select(*keys, "template", place.alias(at), width.alias("width"), F.slice("tokens", place + 1, width).alias("words"))
    slotted = cut.select("*", F.filter("words", lambda t: t < "\x04").alias("slots"))
    literal = (F.size("slots") > WINDOW - PLAIN_WORDS) | (F.col("width") < WINDOW)
    key = F.when(literal, F.xxhash64(F.lit("literal"), "words")).otherwise(F.col("template"))
    # Never NULL by its type, or the join's filter against NULLs would build the slots of all windows before the first join.
    return slotted.select(*keys, "template", at, "width", "slots", F.coalesce(key, F.lit(0)).alias("key"))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``item_id``, ``item_words``, ``words_covered``, ``reworded``) of leaked items.

    An item's windows in a document that lie at the same offset form an alignment. It is consistent if each slot value of
    the item stands for one value of the document throughout; words covered by consistent alignments count. An item is leaked
    if they are ``coverage`` of its words, or ``run`` in one alignment. ``reworded``: some slot has another value than in the
    benchmark.

    Windows with more slots than ``WINDOW - PLAIN_WORDS``, and items of ``SHORTEST`` to ``WINDOW - 1`` words, are found word by
    word only. Items below ``SHORTEST`` words are chance and never leaks. Texts above ``SPAN`` characters are read in spans that
    overlap by twice the longest item, and alignments lie in one span.

    NULL or empty texts and items: no leaks. NULL ids are kept as they are. Repeated rows: one result. Empty tables: no rows.
    Other columns are not read. Documents are told apart by (doc_id, text_hash), so rows that share an id but not the text are
    judged each by its own text.
    """
    longest = benchmark.agg(F.max(F.length("text"))).first()[0] or 0
    items = stored(benchmark.select("item_id", tokens(benchmark["text"]).alias("tokens")).distinct(), "items")
    sized = items.select("item_id", F.xxhash64("tokens").alias("item"), F.size("tokens").alias("item_words"), "tokens")
    few = F.col("item_words").between(SHORTEST, WINDOW - 1)
    short = sorted(r[0] for r in sized.filter(few).select("item_words").distinct().collect())
    sizes = [WINDOW, *short]
    cut = windows(sized.filter(F.col("item_words") >= SHORTEST), ["item_id", "item", "item_words"], "item_at", sizes)
    wanted = stored(
        cut.filter(F.col("width") == F.least("item_words", F.lit(WINDOW))).withColumnRenamed("slots", "item_slots"), "item-windows"
    )
    templates, side = None, wanted.drop("template", "width")
    if wanted.count() <= BROADCAST_WINDOWS:
        templates, side = wanted.select("template").distinct(), F.broadcast(side)
    overlap = 2 * longest + 1000
    parts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), spans(F.col("text"), max(SPAN, 4 * overlap), overlap)
    ).select("doc_id", "text_hash", "part", tokens(F.col("span")).alias("tokens"))
    found = windows(parts, ["doc_id", "text_hash", "part"], "doc_at", sizes, templates).drop("template").join(side, "key")
    item = ["doc_id", "text_hash", "item_id", "item", "item_words"]
    pairs = F.arrays_zip(F.col("item_slots").alias("was"), F.col("slots").alias("now"))
    aligned = found.groupBy(*item, "part", (F.col("doc_at") - F.col("item_at")).alias("offset")).agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("item_at", F.col("item_at") + F.col("width") - 1)))).alias("places"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["was"])))
    judged = aligned.filter(consistent).groupBy(*item).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("words_covered"),
        F.max(F.size("places")).alias("run"), F.bool_or(F.exists("pairs", lambda p: p["was"] != p["now"])).alias("reworded"),
    )
    enough = (F.col("words_covered") >= F.col("item_words") * coverage) | (F.col("run") >= run)
    return judged.filter(enough).drop("item", "run")


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows whose text has a leaked item, with the columns of ``docs``.

    NULL and empty texts stay, NULL ids are judged by their text, all copies of a text go or stay together. Empty tables: no
    rows, or all of them.
    """
    hit = stored(leaks(docs, benchmark, coverage).select(F.col("text_hash").alias("__leaked")).distinct(), "leaked")
    kept = docs.withColumn("__text_hash", F.xxhash64(docs["text"]))
    return kept.join(hit, F.col("__text_hash") == F.col("__leaked"), "left_anti").select(*[kept[c] for c in docs.columns])
