"""Benchmark decontamination by template windows, with DataFrame functions only.

Canonicalisation turns a text into tokens, one per word: a word with a digit becomes `<num>`, a unit after it `<unit>`, a
capitalised word inside a sentence `<name>`; other words are put in lower case and lose their punctuation, and all blanks count alike.
Windows of `WINDOW` tokens of the benchmark items are hash-joined with the windows of all documents, so a question is found again
under other numbers, units and names. Windows in which names are kept as words are joined as well, so a question is also found in
other letter case. For each document, item and alignment, the slots must be consistent: equal values of the item
correspond to equal values in the document and different ones to different ones, for each type of slot.

An item counts as leaked where windows that agree word for word, or all windows of consistent alignments, cover half of its
windows, or a run of `RUN` words.

Two steps keep the work linear in the texts. The first makes one row per window, of a row number and a hash, and joins it
with the hashes of the benchmark, which are broadcast in blocks of at most `BLOCK_WINDOWS`, one pass over the documents each; so memory
has a bound for any benchmark, and document windows are never shuffled. The second cuts only texts with such a window again, and
compares the windows themselves at the places that were found. Before those texts are joined with their places, a bitmap of 2**`MARK_BITS`
marks, of fixed size, keeps nearly all others where they are. The slot values of a group come from one alignment and are no more than
the item has words.

Defined results: a null or empty text holds nothing; items of fewer than `SHORTEST` tokens, or with fewer than that outside
their slots, can't be told from chance and are not sought (such windows of longer items likewise); items with equal
texts are all reported; repeated document keys are reported once, with what either of them holds; a null key is a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.sources.shared import written

WINDOW = 8
RUN = 13
SHORTEST = 5
LITERALS = 4  # words outside of slots that a window needs
SHARE = 0.5
BLOCK_WINDOWS = 500_000  # 16 bytes each
MARK_BITS = 26  # 8 MB in pieces of 2**15 bits, whatever the number of documents

# Units that follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons oz lb lbs pound pounds ml l liter "
    "liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents usd eur mph kmh degrees watts volts"
)
# A slot word stands in `tokens` with its mark before it; the text's own angle brackets count as blanks.
_NAME, _NUMBER, _UNIT = "<", ">", "<>"


def _tokens(text: Column) -> Column:
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), r"[<>\x20\x09-\x0D]+", " ")
    named = F.lower(F.regexp_replace(blank, r"([a-z,;]\x20)(?=[A-Z][a-z])", f"$1{_NAME}"))
    numbered = F.regexp_replace(named, r"(^|\x20)(?=[^\x200-9]*+[0-9])", f"$1{_NUMBER}")
    united = F.regexp_replace(numbered, rf"(>\S++\x20)(?=(?:{'|'.join(UNITS.split())})(?![^\s.,;:!?]))", f"$1{_UNIT}")
    # most texts have few numbers, many have none
    marked = F.when(named.rlike("[0-9]"), united).otherwise(named)
    plain = F.regexp_replace(marked, r"[^\p{L}\p{N}<>\s]++", "")
    return F.filter(F.split(plain, " "), lambda t: ~t.isin("", _NAME))


def _is_slot(form: Column) -> Column:
    return form.startswith("<")


def _template(tokens: Column) -> Column:
    """All slots by type."""
    return F.transform(
        tokens,
        lambda t: F.when(t.startswith(_UNIT), "<unit>").when(t.startswith(_NUMBER), "<num>").when(t.startswith(_NAME), "<name>").otherwise(t),
    )


def _folded(tokens: Column) -> Column:
    """Numbers and units by type, names as words in lower case."""
    return F.transform(
        tokens,
        lambda t: F.when(t.startswith(_UNIT), "<unit>").when(t.startswith(_NUMBER), "<num>").otherwise(F.ltrim(t, F.lit("<"))),
    )


def _surface(tokens: Column) -> Column:
    """The words themselves."""
    return F.transform(tokens, lambda t: F.ltrim(t, F.lit("<>")))


def with_forms(df: DataFrame, text: str) -> DataFrame:
    """Add `tokens`, `template`, `folded` and `surface`, arrays of equal length."""
    # in steps, as each array is used several times
    df = df.withColumn("tokens", _tokens(F.col(text)))
    return df.withColumns({"template": _template(F.col("tokens")), "folded": _folded(F.col("tokens")), "surface": _surface(F.col("tokens"))})


def item_windows(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, length, at, window, hash, item_surface, n_windows) of all items; an item below `WINDOW` tokens is one window.

    A place with names has two windows, with names as slots and as words.
    """
    forms = with_forms(items.select(F.col(item).alias("_item"), F.col(text).alias("_text")), "_text").filter(F.size("tokens") >= SHORTEST)
    sized = forms.withColumn("length", F.least(F.lit(WINDOW), F.size("tokens")))
    placed = sized.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("tokens") - F.col("length") + 1)))
    cut = placed.select("_item", "length", "at", *[F.expr(f"slice({c}, at, length)").alias(c) for c in ("template", "folded", "surface")])
    usable = cut.filter(F.size(F.filter("template", lambda t: ~_is_slot(t))) >= LITERALS)
    # a benchmark item is a text of its own, so its windows are few
    usable = usable.withColumn("n_windows", F.count(F.lit(1)).over(Window.partitionBy("_item")))
    both = usable.withColumn("window", F.explode(F.array_distinct(F.array("template", "folded"))))
    return both.select("_item", "length", "at", "window", _window_hash(F.col("window")).alias("hash"), F.col("surface").alias("item_surface"), "n_windows")


def _window_hash(window: Column) -> Column:
    """The hash of the hashes of a window's tokens."""
    return F.xxhash64(F.transform(window, lambda t: F.xxhash64(t)))


def _hashes(length: int) -> Column:
    """Array of (pos, hash) of all windows of `length` tokens, in the forms `template` and, where it differs, `folded`.

    Both columns hold the hashes of the tokens, so a token is hashed once and not with every window.
    """
    count = F.size("template") - (length - 1)
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def hashed(form: str, at: Column) -> Column:
        return F.transform(at, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice(form, i, length)).alias("hash")))

    named = F.filter(starts, lambda i: F.slice("template", i, length) != F.slice("folded", i, length))
    return F.when(F.col("named"), F.concat(hashed("template", starts), hashed("folded", named))).otherwise(hashed("template", starts))


def _places(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(_row, places) of the documents (_row, _text) with windows whose hash is in the benchmark: array of (pos, length)."""
    tokens = docs.withColumn("tokens", _tokens(F.col("_text"))).drop("_text")

    def hashes(form: Column) -> Column:
        return F.transform(form, lambda t: F.xxhash64(t))

    # names apart, both forms are the same
    forms = tokens.withColumn("named", F.exists("tokens", lambda t: t.startswith(_NAME) & ~t.startswith(_UNIT)))
    forms = forms.withColumn("folded", hashes(_folded(F.col("tokens"))))
    forms = forms.withColumn("template", F.when(F.col("named"), hashes(_template(F.col("tokens")))).otherwise(F.col("folded"))).drop("tokens")
    sought = windows.select("hash", "length").distinct()
    blocks, found = max(1, -(-windows.count() // BLOCK_WINDOWS)), None
    for block in range(blocks):
        part = sought.filter(F.pmod("hash", F.lit(blocks)) == block)
        # nothing of the text but the row and the window's hash gets into a window's row
        each = forms.select("_row", F.explode(F.concat(*map(_hashes, lengths))).alias("w")).select("_row", "w.pos", "w.hash")
        met = each.join(F.broadcast(part), "hash").select("_row", "pos", "length")
        found = met if found is None else found.union(met)
    return found.groupBy("_row").agg(F.collect_set(F.struct("pos", "length")).alias("places"))


def _marked(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The `rows` whose number may be in `places`: its mark is set in a bitmap of fixed size, which is broadcast."""

    def with_mark(df: DataFrame) -> DataFrame:
        mark = F.pmod("_row", F.lit(1 << MARK_BITS))
        return df.withColumns({"_piece": F.shiftright(mark, 15), "_bit": mark.bitwiseAND(F.lit((1 << 15) - 1))})

    marks = with_mark(places.select("_row")).groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = with_mark(rows).join(F.broadcast(marks), "_piece")
    shifted = byte.bitwiseAND(F.pow(F.lit(2), F.col("_bit").bitwiseAND(F.lit(7))).cast("int"))
    return joined.filter(shifted > 0).drop("_piece", "_bit", "_marks")


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document key and item that leaked into it.

    Columns: key, item, `share` of the item's windows found, `longest_run` in words, `exact` (whether the words alone
    suffice), `changed_slots` (slot values that differ from the item's).
    """
    windows = written(item_windows(items, item, item_text), "leaks-windows")
    # at most WINDOW numbers
    lengths = sorted(row[0] for row in windows.select("length").distinct().collect()) or [WINDOW]
    # rows are told apart by key and text: equal ones hold the same
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("_row"))
    places = written(_places(rows.select("_row", "_text"), windows, lengths), "leaks-places")
    again = with_forms(_marked(rows, places).join(places, "_row").select("_key", "_text", "places"), "_text").drop("_text")

    def at_place(p: Column, column: str) -> Column:
        return F.slice(column, p["pos"], p["length"])

    seen = F.transform(
        "places",
        lambda p: F.struct(
            p["pos"].alias("pos"), F.array_distinct(F.array(at_place(p, "template"), at_place(p, "folded"))).alias("forms"), at_place(p, "surface").alias("doc_surface")
        ),
    )
    seen = again.select("_key", F.inline(seen)).select("_key", "pos", "doc_surface", F.explode("forms").alias("doc_window"))
    met = seen.withColumn("hash", _window_hash(F.col("doc_window"))).join(windows, "hash").filter(F.col("doc_window") == F.col("window"))
    matches = met.select(
        "_key", "_item", "n_windows", "length", "at", (F.col("pos") - F.col("at")).alias("offset"), F.col("window").alias("item_template"), "item_surface", "doc_surface"
    )
    slots = F.filter(
        F.zip_with(
            "item_template",
            F.zip_with("item_surface", "doc_surface", lambda i, d: F.struct(i.alias("i"), d.alias("d"))),
            lambda t, v: F.struct(t.alias("t"), v["i"].alias("i"), v["d"].alias("d")),
        ),
        lambda s: s["t"].startswith("<"),
    )
    aligned = (
        matches.withColumns({"slots": slots, "same": F.col("item_surface") == F.col("doc_surface")})
        .groupBy("_key", "_item", "offset")
        .agg(
            F.first("n_windows").alias("n_windows"),
            F.first("length").alias("length"),
            F.collect_set("at").alias("all_at"),
            F.collect_set(F.when(F.col("same"), F.col("at"))).alias("same_at"),
            F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
        )
    )

    def kinds(side):
        return F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["t"], s[side]))))

    consistent = (F.size("slots") == kinds("i")) & (F.size("slots") == kinds("d"))
    usable = aligned.withColumn("at", F.when(consistent, F.col("all_at")).otherwise(F.col("same_at")))

    def run(at):
        """Words of the longest run of consecutive windows."""
        ordered = F.array_sort(at)
        longest = F.aggregate(
            ordered,
            F.struct(F.lit(-9).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best")),
            lambda a, x: F.struct(
                x.cast("int").alias("last"),
                F.when(x == a["last"] + 1, a["now"] + 1).otherwise(F.lit(1)).alias("now"),
                F.greatest(a["best"], F.when(x == a["last"] + 1, a["now"] + 1).otherwise(F.lit(1))).alias("best"),
            ),
            lambda a: a["best"],
        )
        return F.when(longest > 0, longest + F.col("length") - 1).otherwise(0)

    changed = F.size(F.filter("slots", lambda s: s["i"] != s["d"]))
    whole = (
        usable.withColumns({"run": run("at"), "same_run": run("same_at"), "changed": F.when(consistent, changed).otherwise(0)})
        .groupBy("_key", "_item")
        .agg(
            F.first("n_windows").alias("n_windows"),
            F.size(F.array_distinct(F.flatten(F.collect_set("at")))).alias("found"),
            F.size(F.array_distinct(F.flatten(F.collect_set("same_at")))).alias("same_found"),
            F.max("run").alias("longest_run"),
            F.max("same_run").alias("same_run"),
            F.max("changed").alias("changed_slots"),
        )
    )

    def enough(found, longest):
        return (F.col(found) >= SHARE * F.col("n_windows")) | (F.col(longest) >= RUN)

    return whole.filter(enough("found", "longest_run")).select(
        F.col("_key").alias(key),
        F.col("_item").alias(item),
        (F.col("found") / F.col("n_windows")).alias("share"),
        "longest_run",
        enough("same_found", "same_run").alias("exact"),
        "changed_slots",
    )


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` less the rows whose key has a leak; rows with a null key stay."""
    found = leaks(docs.select(key, text), items, key, text).select(key).distinct()
    return docs.join(found, key, "left_anti")


@query("op3_template_leaks")
def op3_template_leaks(spark, folder):
    """Documents that hold a benchmark item, word for word or with other slot values."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
