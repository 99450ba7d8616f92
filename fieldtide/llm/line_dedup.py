"""Line dedup by a log-template tree of fixed depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.llm.common import GAP, stored

DEPTH = 3            # leading tokens that a leaf of the tree shares, besides the token count
MIN_DOCS = ((50, 2), (20, 6), (0, 12))  # (tokens, different texts in which a template of that many must occur to be dropped)
SALTS = 32           # parts of a template's lines in the join with the templates to drop
CONSTANT = 0.5       # share of a leaf's lines that agree on a token for it to be constant
SIMILAR = 0.7        # share of a line's tokens that must equal the leaf's constant tokens


ODD = r"[0-9\x09\x0B-\x0D]"
NUMBERED = r"(?<![^\x20\x09-\x0D])[^0-9\x20\x09-\x0D]*+[0-9][^\x20\x09-\x0D]*+"


def _plain(line: Column) -> Column:
    """The words of a line, one space between two; words with digits are variable fields from the start.

    Lines without digits and with single spaces only, the usual case, are taken as they are.
    """
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ") | line.rlike(ODD)
    return F.when(odd, F.trim(F.regexp_replace(F.regexp_replace(line, NUMBERED, "<*>"), GAP, " "))).otherwise(line)


def _least(tokens: Column, min_docs: Sequence[tuple[int, int]]) -> Column:
    """How many texts must hold a template of so many tokens: the longer it is, the fewer."""
    out = F.lit(None).cast("int")
    for size, docs in sorted(min_docs):
        out = F.when(tokens >= size, F.lit(docs)).otherwise(out)
    return out


def line_templates(docs: DataFrame, text: str, depth: int = DEPTH) -> DataFrame:
    """(doc, line, leaf, form, size, plain): one row per line with a word; doc is a hash of the text, so copies count once."""
    # Lines are made plain before they become rows, so that the filter does not make them so a second time.
    rows = docs.select(F.xxhash64(text).alias("doc"), F.posexplode(F.transform(F.split(text, "\n"), _plain)).alias("line", "plain")).where("plain <> ''")
    size = F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1
    rows = rows.withColumn("size", size)
    leaf = F.xxhash64("size", F.substring_index("plain", " ", depth))
    return rows.select("doc", "line", leaf.alias("leaf"), F.xxhash64("plain").alias("form"), "size", "plain")


def _spread(table: DataFrame) -> DataFrame:
    """A copy of every row for each part."""
    return table.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _part(column: str) -> Column:
    return F.pmod(F.col(column), F.lit(SALTS)).cast("int")


def recurring_lines(docs: DataFrame, text: str = "text", depth: int = DEPTH, min_docs: Sequence[tuple[int, int]] = MIN_DOCS) -> DataFrame:
    """(doc, line): lines whose template occurs in as many different texts as ``min_docs`` asks for at its length.

    The tree is fixed: token count, then the leading tokens. In a leaf each place has its most frequent token, counted
    once per form; it is constant where CONSTANT of the forms agree and a variable field elsewhere. Forms that agree
    with SIMILAR of their tokens share the leaf's template, any other form is a template of its own. Lines are known by
    their hashes; words are moved once for each form of a leaf that has several. Counts are partial aggregates, and joins
    on a leaf or a form are dealt to parts, so a line of a third of all documents is no hot key.
    """
    lines = line_templates(docs, text, depth)
    known = stored(lines.drop("plain"), "template-lines")
    per_text = known.groupBy("leaf", "form", "size", "doc").agg(F.count(F.lit(1)).alias("n"))
    forms = stored(per_text.groupBy("leaf", "form", "size").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs")), "template-forms")
    leaves = forms.groupBy("leaf").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("forms"), F.max("size").alias("size"))
    many = stored(leaves.where((F.col("forms") > 1) & (F.col("lines") >= _least(F.col("size"), min_docs))).select("leaf", "forms"), "template-leaves")
    # Merge joins at every size: the tables grow with the documents.
    said = lines.select("leaf", "form", "plain", _part("doc").alias("part")).join(_spread(many.select("leaf")).hint("merge"), ["leaf", "part"], "left_semi")
    said = said.groupBy("leaf", "form").agg(F.any_value("plain").alias("plain")).withColumn("part", _part("form"))
    said = stored(said, "template-words")
    places = said.select("leaf", F.posexplode(F.split("plain", " ")).alias("place", "token"))
    counts = places.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("c"))
    top = counts.groupBy("leaf", "place").agg(F.max(F.struct("c", "token")).alias("top"))
    constant = F.when(F.col("top.c") >= F.col("forms") * CONSTANT, F.col("top.token"))
    # A leaf has one entry per place: as many as a line has tokens.
    template = top.join(many, "leaf").groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct("place", constant.alias("token"))))["token"].alias("template"))
    marked = said.join(_spread(template), ["leaf", "part"])
    tokens = F.split("plain", " ")
    same = F.size(F.filter(F.zip_with(tokens, "template", lambda t, k: t == k), lambda x: x))
    shared = stored(marked.where(same >= F.size("template") * SIMILAR).select("leaf", "form"), "template-shared")
    of_shared = known.withColumn("part", _part("doc")).join(_spread(shared).hint("merge"), ["leaf", "form", "part"], "left_semi")
    held = of_shared.select("leaf", "size", "doc").distinct().groupBy("leaf", "size").agg(F.count(F.lit(1)).alias("docs"))
    held = held.where(F.col("docs") >= _least(F.col("size"), min_docs)).select("leaf")
    own = forms.where(F.col("docs") >= _least(F.col("size"), min_docs)).select("leaf", "form").join(shared, ["leaf", "form"], "left_anti")
    dropped = stored(own.unionByName(shared.join(held, "leaf", "left_semi")), "template-dropped")
    gone = known.withColumn("part", _part("doc")).join(_spread(dropped).hint("merge"), ["leaf", "form", "part"], "left_semi")
    return gone.select("doc", "line")


def drop_recurring_lines(docs: DataFrame, text: str = "text", depth: int = DEPTH, min_docs: Sequence[tuple[int, int]] = MIN_DOCS) -> DataFrame:
    """Replace the text by its lines that do not recur and add ``n_lines`` and ``n_dropped`` (lines, both).

    Null texts stay null with no lines; a line without a word is never dropped; equal texts count as one document;
    repeated rows are treated alike; an empty table gives no rows. Columns named n_lines or n_dropped are replaced.
    """
    drops = recurring_lines(docs, text, depth, min_docs).groupBy("doc").agg(F.collect_set("line").alias("_drop"))
    rows = docs.drop(*[c for c in ("n_lines", "n_dropped") if c != text])
    rows = rows.withColumn("_doc", F.xxhash64(text))
    # A merge join at every size: the lists grow with the documents, so none of them is ever broadcast.
    joined = rows.join(drops.withColumnRenamed("doc", "_doc").hint("merge"), "_doc", "left")
    lines = F.split(F.col(text), "\n")
    keep = F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.array_contains("_drop", i), F.lit(False))), "\n")
    out = joined.withColumns({
        "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
        "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long"), "_kept": F.when(F.col(text).isNotNull(), keep),
    })
    return out.select(*[(F.col("_kept").alias(text) if c == text else F.col(c)) for c in rows.columns if c != "_doc"], "n_lines", "n_dropped")
