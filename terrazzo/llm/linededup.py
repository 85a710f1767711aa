"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line's set holds its distinct lower-cased tokens (split at white space) as 64-bit codes, ordered by rarity: a code's upper
bits are the logarithm of the frequency, over the whole corpus, of the token's bucket (a table of BUCKETS counts, one byte
each; a token counts once a line). Texts are split once, into a table of each line's token hashes, which is counted and then
made into sets. Lines of equal sets form a node (two 64-bit hashes of the set), which stands at its earliest place. A node is
indexed under its prefix, the size - ceil(size * percent / 100) + 1 rarest tokens. Two nodes that share a prefix token are
candidates if their sizes allow it (length), if enough tokens remain from the shared one onwards (position), and if their
parity bitmaps differ in no more bits than similar sets can differ in tokens. First a node meets, in KEYS lists of common
tokens, the HUBS nodes of the most lines (of a group of variants, those that most copies share); its candidate with the
closest bitmap is verified on the lines themselves. This settles most of a large group. Then the nodes meet in all lists, the
smaller set of a pair with the shorter prefix that suffices for it; pairs whose later node is settled are left out, and every
other candidate is verified. So a settled variant costs about HUBS * KEYS candidates, and nothing is missed.

A line goes if an earlier line (by doc_id, then line number) has a similar set, whether or not that one goes as well.

Defined results: a null text has one empty line and stays null; lines without tokens always stay; a text or line of any
length that fits a value is taken whole; of rows that repeat a doc_id, the earlier line number comes first; rows that repeat
both doc_id and text count as one and get the same result; a null doc_id comes first; doc_id is of any type that can be
ordered; other columns pass through whatever their names, but for n_lines and n_removed, which are replaced; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrazzo.llm.common import drop, stash

BUCKETS, HUBS, KEYS, WIDE = 1 << 20, 8, 2, 64
COMMON = 14  # a frequency class: from 128 lines on
PLAIN = {"parquet.enable.dictionary": "false"}  # hashes hardly repeat within a page
SPACE = " \t\r\f\v"
NODE = ("h", "doc_id", "n")
POINTER = (1 << 56) - 1


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def split_tokens(line: Column) -> Column:
    """Lower-cased pieces between white space; empty ones too. A split at one blank needs no regular expression."""
    odd = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\f")) | F.contains(line, F.lit("\v"))
    return F.split(F.lower(F.when(odd, F.translate(line, "\t\r\f\v", "    ")).otherwise(line)), " ", -1)


def is_blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(SPACE)) == ""  # stops at the first other character


def line_tokens(documents: DataFrame) -> DataFrame:
    """doc_id, n, row (a hash of the text), h, h2 (two hashes of the line's token set), toks (64-bit hashes of its distinct tokens), as a table: a row
    for each line that holds tokens. Texts are split into tokens here, and again only to verify."""
    lines = documents.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(split_lines(F.col("text"))).alias("n", "line")).where(~is_blank(F.col("line")))
    hashes = F.array_remove(F.transform(split_tokens(F.col("line")), lambda t: F.xxhash64(t)), F.xxhash64(F.lit("")))
    sets = lines.select("doc_id", "n", "row", F.array_distinct(hashes).alias("toks")).withColumn("set", F.sort_array("toks"))
    return stash(sets.select("doc_id", "n", "row", F.xxhash64("set").alias("h"), F.xxhash64(F.lit(1), "set").alias("h2"), "toks"), "line-tokens", PLAIN)


def rarity(lines: DataFrame) -> DataFrame:
    """One row of one array: the frequency class (0 to 63, the logarithm to a base of the square root of 2) of each bucket, in the upper
    bits of a long."""
    token = lines.select(F.explode("toks").alias("t"))
    counts = token.groupBy(F.col("t").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).agg(F.count("*").alias("c"))
    level = F.shiftleft(F.least(F.lit(63), F.floor(2 * F.log2(F.coalesce("c", F.lit(1))))).cast("long"), 57)
    every = lines.sparkSession.range(BUCKETS).join(counts, F.col("id") == F.col("b"), "left")
    row = F.sort_array(F.collect_list(F.struct(F.col("id").cast("int"), level.alias("level"))))
    return stash(every.agg(row.alias("x")).select(F.transform("x", lambda e: e.level).alias("levels")), "line-rarity")


def rarest_first(tokens: Column, levels: Column) -> Column:
    """Codes of tokens, rarest first."""
    code = lambda h: F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).bitwiseOR(F.shiftrightunsigned(h, 7))
    return F.sort_array(F.transform(tokens, lambda h: F.coalesce(code(h), F.lit(0).cast("long"))))  # never null: longs that cannot be null sort fastest


def parity(tokens: Column, one: Callable[[Column], Column]) -> Column:
    """64 bits, of which each token flips one if `one` of it is 1, and none if it is 0."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(F.call_function("shiftleft", one(t), t.bitwiseAND(F.lit(63)).cast("int"))))


def line_nodes(lines: DataFrame, levels: DataFrame, percent: int) -> DataFrame:
    """h, doc_id, n (its earliest place), row (a hash of the text there), lines (how many), size, bits, more (64 bits of parity of all tokens, and, in sets
    of more than WIDE, of half of them), prefix: a row for each distinct token set."""
    # the table is a scalar sub-query: each task holds it once, and no row carries it
    codes = lines.withColumn("levels", levels.scalar()).withColumn("codes", rarest_first(F.col("toks"), F.col("levels")))
    size = F.size("toks")
    prefix = F.slice("codes", F.lit(1), size - F.floor((size * percent + 99) / 100).cast("int") + 1)
    bits = parity(F.col("toks"), lambda t: F.lit(1).cast("long"))
    more = F.when(size > WIDE, parity(F.col("toks"), lambda t: F.shiftrightunsigned(t, 63))).otherwise(F.lit(0).cast("long"))
    own = F.struct(size.alias("size"), bits.alias("bits"), more.alias("more"), prefix.alias("prefix")).alias("set")
    wide = codes.select("h", "h2", F.struct("doc_id", "n", "row").alias("place"), own)
    nodes = wide.groupBy("h", "h2").agg(F.min("place").alias("place"), F.count("*").alias("lines"), F.first("set").alias("set"))
    return nodes.select("h", "place.*", "lines", "set.size", "set.bits", "set.more", "set.prefix")


def level(tok: Column) -> Column:
    """The frequency class of a code."""
    return F.shiftrightunsigned(tok, 57)


def present(keys: DataFrame, column: str) -> DataFrame:
    """One row of one array: for each of BUCKETS buckets, whether it holds a key."""
    own = keys.select(F.col(column).bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).distinct()
    every = keys.sparkSession.range(BUCKETS).join(own, F.col("id") == F.col("b"), "left")
    row = F.sort_array(F.collect_list(F.struct(F.col("id").cast("int"), F.col("b").isNotNull().alias("there"))))
    return stash(every.agg(row.alias("x")).select(F.transform("x", lambda e: e.there).alias("there")), "line-present")


def among(flags: DataFrame, column: str) -> Column:
    return F.coalesce(F.get(flags.scalar(), F.col(column).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), F.lit(False))


def earlier() -> Column:
    place = lambda side: F.struct(*(F.col(f"{side}.{c}") for c in ("doc_id", "n", "h")))
    return place("y") < place("x")


def candidate(percent: int) -> Column:
    """Whether x and y can be similar if the token they share is the first they share."""
    x, y = (lambda c, s=s: F.col(f"{s}.{c}") for s in "xy")
    both = x("size") + y("size")
    sized = 100 * F.least(x("size"), y("size")) >= percent * F.greatest(x("size"), y("size"))
    placed = (100 + percent) * F.least(x("size") - x("pos"), y("size") - y("pos")) >= percent * both
    return (differ() * (100 + percent) <= both * (100 - percent)) & placed & sized  # in order of what most pairs fail by


def differ() -> Column:
    """How many tokens of x and y differ at least. Short sets tell each other apart by one bitmap; two long ones have a bitmap for each half of the tokens."""
    bits, more = F.col("x.bits").bitwiseXOR(F.col("y.bits")), F.col("x.more").bitwiseXOR(F.col("y.more"))
    return F.when((F.col("x.size") > WIDE) & (F.col("y.size") > WIDE), F.bit_count(bits.bitwiseXOR(more)) + F.bit_count(more)).otherwise(F.bit_count(bits))


def verified(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """The later nodes of those pairs (p, q) of pointers that lead to similar nodes, as a table. A pointer has 56 bits of h, so
    it may lead to other nodes too, which are verified alike."""
    places = nodes.select(*NODE, "row", F.shiftrightunsigned("h", 8).alias("p"))
    ends = pairs.select("p").unionByName(pairs.select(F.col("q").alias("p"))).distinct()
    needed = stash(places.join(ends, "p", "left_semi"), "line-needed")
    flags = present(needed, "row")
    wanted = needed.groupBy("doc_id", "row").agg(F.collect_list(F.struct("h", "n", "p")).alias("wanted")).alias("y")
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("row")).where(among(flags, "row")).alias("x")
    texts = texts.join(wanted, (F.col("x.row") == F.col("y.row")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")))
    lines = texts.select("x.doc_id", split_lines(F.col("text")).alias("own"), F.explode("wanted").alias("w")).select("w.*", "doc_id", F.get("own", F.col("w.n")).alias("line"))
    tokens = F.array_distinct(F.array_remove(split_tokens(F.col("line")), ""))
    lines = stash(lines.select(*NODE, "p", tokens.alias("toks")), "line-sets")

    c, x, y = pairs.alias("c"), lines.alias("x"), lines.alias("y")
    wide = c.join(x, F.col("c.p") == F.col("x.p")).select("x.*", "c.q").alias("x").join(y, F.col("x.q") == F.col("y.p"))
    node = lambda side: F.struct(*(F.col(f"{side}.{k}") for k in NODE))
    wide = wide.select(F.when(earlier(), node("x")).otherwise(node("y")).alias("later"), F.col("x.toks").alias("tx"), F.col("y.toks").alias("ty"), (node("x") == node("y")).alias("same"))
    wide = wide.where("not same").withColumn("common", F.size(F.array_intersect("tx", "ty")))
    alike = 100 * F.col("common") >= percent * (F.size("tx") + F.size("ty") - F.col("common"))
    found = stash(wide.where(alike).select("later.*").distinct(), "line-verified")
    drop(needed, flags, lines)
    return found


def without(nodes: DataFrame, gone: DataFrame) -> DataFrame:
    x, y = nodes.alias("x"), gone.alias("y")
    return x.join(y, (F.col("x.h") == F.col("y.h")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.n") == F.col("y.n")), "left_anti")


def common_lists(nodes: DataFrame) -> DataFrame:
    """The nodes by KEYS tokens of their prefixes: the rarest of those that are common enough for long lists; where there are too few, the last ones. pos is 0,
    as sets may share other tokens first."""
    there = nodes.where("size is not null and bits is not null and more is not null and lines is not null")  # as any join on them implies: see below
    rare = F.size(F.filter("prefix", lambda tok: level(tok) < COMMON))
    keys = F.slice("prefix", F.greatest(F.lit(1), F.least(rare, F.size("prefix") - KEYS) + 1), F.lit(KEYS))
    return there.select(*NODE, "lines", "size", "bits", "more", F.lit(0).alias("pos"), F.explode(keys).alias("tok"))


def near_hubs(nodes: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """The nodes (h, doc_id, n) that are similar to an earlier hub of their common lists, as a table."""
    listed = common_lists(nodes)
    rank = F.row_number().over(Window.partitionBy("tok").orderBy(F.desc("lines"), "doc_id", "n", "h")).alias("rank")
    hubs = listed.select("*", rank).where(F.floor((F.col("rank") - 1) / HUBS) == 0)
    # always true, and of both sides: they keep the same columns and filters, so one exchange serves both
    both = F.coalesce("x.lines", "y.lines") > 0
    met = listed.alias("x").join(hubs.alias("y"), (F.col("x.tok") == F.col("y.tok")) & both & candidate(percent) & earlier())
    pointer = F.shiftleft(F.least(differ(), F.lit(127)).cast("long"), 56).bitwiseOR(F.shiftrightunsigned("y.h", 8)).alias("pointer")
    best = met.select(*(F.col(f"x.{c}") for c in NODE), pointer).groupBy(*NODE).agg(F.min("pointer").bitwiseAND(F.lit(POINTER)).alias("q"))
    best = stash(best.select(F.shiftrightunsigned("h", 8).alias("p"), "q"), "line-best")
    near = verified(best, nodes, documents, percent)
    drop(best)
    return near


def similar_nodes(nodes: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """The nodes (h, doc_id, n) that have an earlier similar one, as a table."""
    near = near_hubs(nodes, documents, percent)
    x, y = nodes.alias("x"), near.withColumn("settled", F.lit(True)).alias("y")
    same = (F.col("x.h") == F.col("y.h")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.n") == F.col("y.n"))
    marked = x.join(y, same, "left").select("x.h", "x.doc_id", "x.size", "x.bits", "x.more", F.coalesce("settled", F.lit(False)).alias("settled"), "x.prefix")
    listed = marked.select("h", "doc_id", "size", "bits", "more", "settled", F.posexplode("prefix").alias("pos", "tok")).where(level(F.col("tok")) > 0)
    # x is the larger, y the smaller set, which holds the first token they share even earlier: all but 2 * percent / (100 + percent) of its size come after it
    ordered = (F.col("y.size") < F.col("x.size")) | ((F.col("y.size") == F.col("x.size")) & (F.col("y.h") < F.col("x.h")))
    short = (100 + percent) * (F.col("y.size") - F.col("y.pos")) >= 2 * percent * F.least("y.size", "x.size")  # of both sides, so one exchange serves both
    late = lambda a, b: F.coalesce(F.col(f"{a}.settled") & ((F.col(f"{a}.doc_id") > F.col(f"{b}.doc_id")) | F.col(f"{b}.settled")), F.lit(False))
    met = (F.col("x.tok") == F.col("y.tok")) & ordered & short & candidate(percent) & ~late("x", "y") & ~late("y", "x")
    rest = listed.alias("x").join(listed.alias("y"), met)
    rest = stash(rest.select(F.shiftrightunsigned("x.h", 8).alias("p"), F.shiftrightunsigned("y.h", 8).alias("q")).distinct(), "line-rest")
    late = verified(rest, nodes, documents, percent)
    found = stash(near.unionByName(late).distinct(), "line-similar")
    drop(near, rest, late)
    return found


def dedup_lines(documents: DataFrame, percent: int = 80) -> DataFrame:
    """All columns of documents, with `text` of the remaining lines, and n_lines, n_removed."""
    others = [F.col(f"`{c}`") for c in documents.columns if c not in ("text", "n_lines", "n_removed")]
    own = documents.select("doc_id", "text")
    lines = line_tokens(own)
    levels = rarity(lines)
    nodes = stash(line_nodes(lines, levels, percent), "line-nodes")
    drop(lines)
    similar = similar_nodes(nodes, own, percent)
    kept = stash(without(nodes.select(*NODE, "row"), similar).groupBy("doc_id", "row").agg(F.collect_list("n").alias("own")), "line-kept")
    drop(levels, nodes, similar)

    rows = documents.select(F.struct(*others, F.col("text")).alias("d"), F.xxhash64("text").alias("row")).alias("x")
    same = (F.col("x.row") == F.col("y.row")) & F.col("x.d.doc_id").eqNullSafe(F.col("y.doc_id"))
    rows = rows.join(kept.alias("y"), same, "left").select("d", "own").withColumn("lines", split_lines(F.col("d.text")))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    blank = F.filter(every, lambda i: is_blank(F.get("lines", i)))
    stay = F.sort_array(F.array_union(F.array_intersect(every, F.coalesce("own", F.expr("cast(array() as array<int>)"))), blank))
    rows = rows.withColumn("stay", stay)
    text = F.when(F.col("d.text").isNotNull(), F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    sizes = F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("n_removed")
    named = [text.alias(c) if c == "text" else F.col("d").getField(c).alias(c) for c in documents.columns if c not in ("n_lines", "n_removed")]
    return rows.select(*named, *sizes)
