"""Document fingerprints: a Merkle tree over chunks, paragraphs and sections, with DataFrame functions only.

A text's paragraphs are its lines. Each is cut into chunks (to the end of a sentence, 16 characters at most, to see edits
of the shortest texts), the leaves. A leaf is a digest of its characters; a paragraph's node is the digest of its leaves, a
section's node that of its paragraphs' nodes, the root that of the sections' nodes. A section ends after a paragraph whose
node begins with 0 or 8, so the text itself sets the borders and an edit moves none but its own.

The fingerprint is the tree in one string: the root, then the shortened nodes of sections, paragraphs and chunks. Equal
texts have equal fingerprints, and roots test equality. ``with_likeness`` and ``edit_span`` go down from the top and look
only into branches that differ, so the differing branches locate an edit.

Scale: a tree is made within its row, linear in the text. ``with_next`` gives each row the beginning of the next text by id
and its fingerprint: keys of rows (id, first characters and hash of the text) are put in order by range partitions, each
row learns who comes before it, and sends the characters that this one needs there. Texts are shuffled once, by hashes of
id and text, into partitions that follow the characters; only rows of equal id and text meet in one task.

Edge cases: a null text counts as empty; an empty text has one empty paragraph and no chunk; a lone document follows
itself; repeated ids follow each other in the order of their texts (of their first 100 characters, then of a hash); rows of
equal id and text are one document, each with the same result; null ids come first; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.llm.shared import fresh_prefix, written

CHUNK_PATTERN = r"[^.!?]{0,15}[.!?]+ ?|[^.!?]{1,16}"
#: Hexadecimal digits of a leaf and of a node in the tree, and of a leaf and of a node in the fingerprint.
LEAF, NODE, SHORT_LEAF, SHORT_NODE = 16, 32, 6, 8
#: Keys of a range partition, and the characters of the text in a key.
PART_ROWS = 500_000
#: Characters of text in a partition of the joins.
PART_CHARS = 16_000_000
KEY_CHARS = 100


def with_tree(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``df`` with a struct ``out_col``: root, sections (array of node, paragraphs (array of node, chunks (array)))."""
    names = [c for c in df.columns if c.lower() != out_col.lower()]
    q = fresh_prefix(df)
    chunks, par, ends, sections = (f"{q}{x}" for x in ("chunks", "par", "ends", "sections"))
    digest = lambda c, n: F.substring(F.sha2(c, 256), 1, n)
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    df = df.select(*names, F.transform(lines, lambda p: F.transform(F.regexp_extract_all(p, F.lit(CHUNK_PATTERN), F.lit(0)), lambda c: digest(c, LEAF))).alias(chunks))
    df = df.select(*names, F.transform(chunks, lambda c: F.struct(digest(F.array_join(c, ""), NODE).alias("node"), c.alias("chunks"))).alias(par))
    p, e = F.col(par), F.col(ends)
    df = df.select("*", F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: F.get(p, i - 1)["node"].substr(1, 1).isin("0", "8") | (i == F.size(p))).alias(ends))
    df = df.select(*names, F.transform(e, lambda end, k: F.slice(p, F.coalesce(F.get(e, k - 1), F.lit(0)) + 1, end - F.coalesce(F.get(e, k - 1), F.lit(0)))).alias(sections))
    df = df.select(*names, F.transform(sections, lambda s: F.struct(
        digest(F.array_join(F.transform(s, lambda x: x["node"]), ""), NODE).alias("node"), s.alias("paragraphs"))).alias(sections))
    root = F.sha2(F.array_join(F.transform(sections, lambda s: s["node"]), ""), 256)
    return df.select(*names, F.struct(root.alias("root"), F.col(sections).alias("sections")).alias(out_col))


def fingerprint(tree: Column) -> Column:
    """A tree as a string: root:section/section…, a section node=paragraph.paragraph…, a paragraph its node and its leaves."""
    short = lambda p: F.concat(p["node"].substr(1, SHORT_NODE), F.array_join(F.transform(p["chunks"], lambda c: c.substr(1, SHORT_LEAF)), ""))
    section = lambda s: F.concat(s["node"].substr(1, SHORT_NODE), F.lit("="), F.array_join(F.transform(s["paragraphs"], short), "."))
    return F.concat(tree["root"], F.lit(":"), F.array_join(F.transform(tree["sections"], section), "/"))


def with_fingerprint(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``df`` with the fingerprint of a text column."""
    q = fresh_prefix(df) + "tree"
    names = [c for c in df.columns if c.lower() != out_col.lower()]
    return with_tree(df, text_col, q).select(*names, fingerprint(F.col(q)).alias(out_col))


def _same_from_start(a: Column, b: Column) -> Column:
    """How many elements two arrays share from their start."""
    n = F.least(F.size(a), F.size(b))
    at = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(at > 0, at - 1).otherwise(n).cast("int")


def _paragraphs(sections: Column) -> Column:
    """The paragraphs of a fingerprint's sections, in order."""
    return F.flatten(F.transform(sections, lambda s: F.split(F.substring_index(s, "=", -1), r"\.")))


def _chunks(paragraphs: Column) -> Column:
    """The leaves of a fingerprint's paragraphs, in order."""
    return F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(p.substr(F.lit(SHORT_NODE + 1), F.length(p)), F.lit(f".{{{SHORT_LEAF}}}"), F.lit(0))))


def with_likeness(df: DataFrame, a: str, b: str, out_col: str) -> DataFrame:
    """``df`` with the likeness (0 to 1) of two fingerprint columns: the share of leaves in both (Dice), or of those unchanged
    from either end if that is more.

    Sections in both are shared as they are; in the others, paragraphs in both; only in the rest leaves are compared. Of
    sections, paragraphs and, for the Dice share, leaves that a text repeats, one counts.
    """
    names = [c for c in df.columns if c.lower() != out_col.lower()]
    q = fresh_prefix(df)
    c = lambda x: F.col(q + x)
    sections = lambda f: F.split(F.substring_index(F.col(f), ":", -1), "/")
    df = df.select(*names, sections(a).alias(q + "sa"), sections(b).alias(q + "sb"))
    df = df.select(
        *names, _paragraphs(F.array_except(c("sa"), c("sb"))).alias(q + "pa"), _paragraphs(F.array_except(c("sb"), c("sa"))).alias(q + "pb"),
        F.size(_chunks(_paragraphs(F.array_intersect(c("sa"), c("sb"))))).alias(q + "n"))
    df = df.select(
        *names, _chunks(F.array_except(c("pa"), c("pb"))).alias(q + "x"), _chunks(F.array_except(c("pb"), c("pa"))).alias(q + "y"),
        (c("n") + F.size(_chunks(F.array_intersect(c("pa"), c("pb"))))).alias(q + "n"))
    x, y, n = c("x"), c("y"), c("n")
    longest = n + F.greatest(F.size(x), F.size(y))
    ends = n + F.least(_same_from_start(x, y) + _same_from_start(F.reverse(x), F.reverse(y)), F.least(F.size(x), F.size(y)))
    shared = 2.0 * (n + F.size(F.array_intersect(x, y))) / (2 * n + F.size(F.array_distinct(x)) + F.size(F.array_distinct(y)))
    return df.select(*names, F.when(F.col(a) == F.col(b), 1.0).when(longest == 0, 0.0).otherwise(F.greatest(shared, ends / longest)).alias(out_col))


def edit_span(a: Column, b: Column) -> Column:
    """Where two trees differ: struct(first, last_a, last_b) of paragraph numbers from 0, null where the roots agree.

    Only paragraphs of the sections between the first and the last that differ are compared.
    """
    x, y = a["sections"], b["sections"]
    nodes = lambda s: F.transform(s, lambda n: n["node"])
    head = _same_from_start(nodes(x), nodes(y))
    tail = F.least(_same_from_start(F.reverse(nodes(x)), F.reverse(nodes(y))), F.least(F.size(x), F.size(y)) - head)
    inner = lambda s: F.flatten(F.transform(F.slice(s, head + 1, F.size(s) - head - tail), lambda n: nodes(n["paragraphs"])))
    before = F.aggregate(F.slice(x, F.lit(1), head), F.lit(0), lambda n, s: n + F.size(s["paragraphs"]))
    p, r = inner(x), inner(y)
    first = _same_from_start(p, r)
    last = F.least(_same_from_start(F.reverse(p), F.reverse(r)), F.least(F.size(p), F.size(r)) - first)
    return F.when(a["root"] != b["root"], F.struct(
        (before + first).alias("first"), (before + F.size(p) - last - 1).alias("last_a"), (before + F.size(r) - last - 1).alias("last_b")))


def _befores(keys: DataFrame) -> DataFrame:
    """Distinct ``keys`` (i, t, h, n) with before: struct(i, t, h, n) of the row before in the order of i, t, h; of the first, the last."""
    parts = max(1, -(-keys.count() // PART_ROWS))
    placed = written(keys.repartitionByRange(parts, "i", "t", "h").withColumn("part", F.spark_partition_id()), "keys")
    whole = F.struct("i", "t", "h", "n")
    # a row for each range partition
    order, every = Window.orderBy("part"), Window.partitionBy()
    ends = placed.groupBy("part").agg(F.max(whole).alias("last"))
    ends = ends.select(F.col("part").alias("own_part"), F.coalesce(F.lag("last").over(order), F.max("last").over(every)).alias("border"))
    inside = F.lag(whole).over(Window.partitionBy("part").orderBy("i", "t", "h"))
    return placed.withColumn("inside", inside).join(F.broadcast(ends), F.col("part") == F.col("own_part")).select(
        "i", "h", F.coalesce("inside", "border").alias("before"))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", next_col: str = "next", share: float = 0.25) -> DataFrame:
    """(id, text, next) of every row; ``next`` is struct(id, text, fingerprint) of the next document by id, after the last the first.

    ``next.text`` is the beginning of the next text, ``share`` times as long as the row's own text (or all of it). A caller
    that uses ``next.id`` too has the texts shuffled once: both joins then read the same columns.
    """
    # a document goes by 128 bits of hashes of its id (null has one too) and its text
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = written(rows.groupBy("i", F.substring("text", 1, KEY_CHARS).alias("t"), "h", F.length("text").alias("n")).agg(F.count("*").alias("copies")), "documents")
    before = _befores(keys.drop("copies")).select(F.col("h").alias("kh"), F.xxhash64("i").alias("kk"), "before")
    total = keys.agg(F.max("copies").alias("most"), F.sum(F.col("n") * F.col("copies")).alias("chars")).first()
    # both joins deal the texts by the same key, whatever their size: one shuffle, its partitions by the characters
    rows = rows.withColumn("k", F.xxhash64("i")).repartition(max(1, -(-(total["chars"] or 0) // PART_CHARS)), "k", "h")
    once = rows if (total["most"] or 0) < 2 else rows.dropDuplicates(["k", "h"])
    known = once.join(before.hint("merge"), (F.col("k") == F.col("kk")) & (F.col("h") == F.col("kh")))
    sent = known.select(
        F.xxhash64("before.i").alias("kk"), F.col("before.h").alias("kh"), "i", "text",
        F.expr(f"left(text, cast(floor(before.n * {share}D) as int))").alias("head"))
    sent = with_fingerprint(sent, "text", "print").select(
        "kk", "kh", F.struct(F.col("i").alias("id"), F.col("head").alias("text"), F.col("print").alias("fingerprint")).alias("next"))
    got = rows.join(sent.hint("merge"), (F.col("k") == F.col("kk")) & (F.col("h") == F.col("kh")))
    return got.select(F.col("i").alias(id_col), F.col("text").alias(text_col), F.col("next").alias(next_col))
