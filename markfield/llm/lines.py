"""Line deduplication by log templates, with built-in functions only.

Lines are parsed by a tree of fixed depth: the token count, then the leading tokens, variable ones (numbers and
the like) masked. Inside a leaf a position is constant where one token stands in at least ``share`` of the leaf's
documents; other positions are generalised. Lines that keep at least ``fixed`` of their tokens follow the
leaf's template, and a template found in ``documents`` or more documents is dropped wherever it occurs. A line whose
masked words as a whole recur is its own template.

Statistics cover every line of every document. Texts are cut into lines where they lie; only hashes are
shuffled, combined first, and tokens only of distinct lines in leaves that recur, so one very common line moves one
row per task. A document counts once for a leaf, a token and a template, however many of its lines are of that form:
documents with several such lines are counted apart. Documents without dropped lines keep their text as it is.

A null text is empty and has one empty line; empty lines are never dropped; equal lines of one document count once;
repeated rows are documents of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import settle, small_side, table, whole

#: Tokens that vary: anything with a digit, from the start of the token.
VARIABLE = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
#: White space other than single spaces between tokens.
RUNS = r"[\t\r\x0b\x0c]|^ |  | $"
#: Small key tables are broadcast up to this counted number of rows, else shuffled.
BROADCAST_ROWS = 500_000


@dataclass
class Settings:
    leading: int = 3  #: leading tokens on the tree's path
    documents: int = 5  #: documents a template must occur in to be dropped
    share: float = 0.5  #: of a leaf's documents a constant token must occur in
    fixed: float = 0.7  #: of a line's tokens must be constant


def masked(line: Column) -> Column:
    """The line's tokens with variable ones replaced, joined by single spaces."""
    plain = F.when(line.rlike(RUNS), F.trim(F.regexp_replace(line, r"[\t\r\x0b\x0c ]+", " "))).otherwise(line)
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, VARIABLE, "<*>")).otherwise(plain)


def parsed(line: Column, leading: int) -> Column:
    """Struct (line, leaf): hashes of a masked line, and of its token count and leading tokens; null without tokens."""
    tokens = F.split(line, " ")
    leaf = F.xxhash64(F.size(tokens), F.array_join(F.slice(tokens, 1, leading), " "))
    return F.when(line != "", F.struct(F.xxhash64(line).alias("line"), leaf.alias("leaf")))


def cut(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``at, doc_id, text, hashes`` in the shared folder: texts with the hashes of every line, parsed once."""
    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    lines = F.transform(F.split("text", "\n", -1), masked)
    hashes = F.transform(lines, lambda line: parsed(line, settings.leading))
    return settle(rows.withColumn("hashes", hashes), "lines")


def repeated(rows: DataFrame) -> DataFrame:
    """``at, leaf, line, raw``: the distinct lines of every document that has several of one leaf.

    A line has one leaf, so a document with more distinct lines than leaves has such lines. Counting both takes time in
    proportion to the lines; only the documents found are taken apart.
    """
    told = F.filter("hashes", lambda h: h.isNotNull())
    lines, leaves = F.transform(told, lambda h: h["line"]), F.transform(told, lambda h: h["leaf"])
    apart = rows.filter(F.size(F.array_distinct(lines)) > F.size(F.array_distinct(leaves))).select("at", F.explode(
        F.arrays_zip(F.split("text", "\n", -1).alias("raw"), F.col("hashes").alias("h"))).alias("z"))
    once = apart.filter("z.h is not null").groupBy("at", F.col("z.h.leaf").alias("leaf"), F.col("z.h.line").alias("line")).agg(
        F.first("z.raw").alias("raw"))
    several = once.groupBy("at", "leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return once.join(several.hint("merge"), ["at", "leaf"], "left_semi")


def over(rows: DataFrame, *by: str) -> DataFrame:
    """``by, over``: how often documents ``at`` are counted beyond once when their lines are summed."""
    return rows.groupBy("at", *by).agg((F.count(F.lit(1)) - 1).alias("over")).filter("over > 0").groupBy(*by).agg(
        F.sum("over").alias("over"))


def documents_of(lines: DataFrame, repeats: DataFrame, *by: str) -> DataFrame:
    """``by, n``: distinct documents of each group of lines: the sum over lines, less what ``repeats`` count twice."""
    summed = lines.groupBy(*by).agg(F.sum("documents").alias("n"))
    return summed.join(over(repeats, *by), list(by), "left").withColumn("n", F.col("n") - F.coalesce("over", F.lit(0))).drop("over")


def recurring(rows: DataFrame, settings: Settings) -> DataFrame:
    """Hashes ``line`` of all lines whose template occurs in enough documents."""
    once = rows.select(F.explode(F.array_distinct(F.transform("hashes", lambda h: h["line"]))).alias("line")).groupBy("line").agg(
        F.count(F.lit(1)).alias("documents"))
    leaf_of = rows.select(F.explode("hashes").alias("h")).filter("h is not null").groupBy("h.line").agg(F.first("h.leaf").alias("leaf"))
    counts = settle(leaf_of.join(once, "line"), "line-counts")
    several = settle(repeated(rows), "repeated-leaves")
    leaves = settle(documents_of(counts, several, "leaf").withColumnRenamed("n", "all").filter(
        F.col("all") >= settings.documents), "leaves")
    raw = rows.select(F.explode(F.arrays_zip(F.split("text", "\n", -1).alias("raw"), F.col("hashes").alias("h"))).alias("z"))
    raw = raw.select("z.raw", "z.h.leaf", "z.h.line").filter("leaf is not null").join(
        small_side(leaves.select("leaf"), leaves.count(), BROADCAST_ROWS), "leaf", "left_semi")
    texts = raw.groupBy("leaf", "line").agg(F.first("raw").alias("raw")).select("leaf", "line", masked(F.col("raw")).alias("masked"))
    known = settle(texts.join(counts, ["leaf", "line"]), "line-texts")
    tokens = known.select("leaf", "line", "documents", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    several = several.join(small_side(leaves.select("leaf"), leaves.count(), BROADCAST_ROWS), "leaf", "left_semi")
    again = several.select("at", "leaf", F.posexplode(F.split(masked(F.col("raw")), " ")).alias("place", "token"))
    stood = documents_of(tokens, again, "leaf", "place", "token")
    constant = stood.join(leaves, "leaf").filter(F.col("n") >= F.col("all") * settings.share).select("leaf", "place", "token")
    kept = tokens.join(constant, ["leaf", "place", "token"], "left_semi").groupBy("leaf", "line").agg(
        F.count(F.lit(1)).alias("kept"))
    followed = settle(known.join(kept, ["leaf", "line"]).filter(
        F.col("kept") >= settings.fixed * F.size(F.split("masked", " "))).select("leaf", "line", "documents"), "followed")
    again = several.select("at", "leaf", "line").join(
        small_side(followed.select("leaf", "line"), followed.count(), BROADCAST_ROWS), ["leaf", "line"], "left_semi")
    heavy = documents_of(followed, again, "leaf").filter(F.col("n") >= settings.documents)
    whole_lines = known.filter(F.col("documents") >= settings.documents).select("line")
    return settle(followed.join(heavy, "leaf", "left_semi").select("line").union(whole_lines).distinct(), "recurring")


def between(lines: Column, gone: Column) -> Column:
    """The lines but those at the ascending places ``gone``: the stretches between them, each cut out once.

    Both arrays are bound to a variable, so that they are not evaluated again for every stretch.
    """
    def stretch(held: Column, n: Column) -> Column:
        after = F.coalesce(F.when(n > 0, F.get(held["gone"], n - 1)), F.lit(-1))
        until = F.coalesce(F.get(held["gone"], n), F.size(held["lines"]))
        return F.slice(held["lines"], after + 2, until - after - 1)

    held = F.array(F.struct(lines.alias("lines"), gone.alias("gone")))
    return F.transform(held, lambda one: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(one["gone"])), lambda n: stretch(one, n))))[0]


def without_recurring(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, dropped, text``: every document without its recurring lines."""
    settings = settings or Settings()
    rows = cut(docs, settings, id_col, text_col)
    hashes = recurring(rows, settings)
    known = small_side(hashes, hashes.count(), BROADCAST_ROWS)
    gone = rows.select("at", F.posexplode("hashes").alias("place", "h")).select("at", "place", "h.line").join(known, "line")
    flags = settle(gone.groupBy("at").agg(F.count(F.lit(1)).alias("dropped"), F.array_sort(F.collect_list("place")).alias("gone")), "dropped-lines")
    size = flags.agg(F.sum(F.col("dropped") + 1)).first()[0] or 0
    lines = F.split("text", "\n", -1)
    return rows.select("at", "doc_id", "text").join(small_side(flags, size, BROADCAST_ROWS), "at", "left").select(
        "doc_id", F.size(lines).alias("n_lines"), F.coalesce("dropped", F.lit(0)).cast("int").alias("dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(
            F.array_join(between(lines, F.col("gone")), "\n")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped of every document, and a digest of what stays."""
    found = without_recurring(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "dropped", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))
