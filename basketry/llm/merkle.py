"""A Merkle manifest of documents: a digest tree per source, one over the sources.

Leaves are numbered within their source by a range sort, so that a source with
a large part of all rows is spread. Each aligned block of ``ARITY ** 2`` leaves
is one row that keeps a level of its tree as one string of concatenated hex
digests. Fixed-width substrings of a level are the runs whose digests make the
next level; what flanks a digest within its run are its siblings. A block ends in
one digest; those digests are the leaves of the next, 256 times smaller, table,
until a source has one left. The sources' roots go through the same steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketry.operators.ranking import with_number_in_group, with_row_number
from basketry.session import materialize

#: Digests in a run, levels that a block climbs, characters of a digest.
ARITY, LEVELS, WIDTH = 16, 2, 64
BLOCK = ARITY**LEVELS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' bytes, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as it enters a leaf: its byte count, a colon, its text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def tampered_text(text: Column) -> Column:
    """The text with A-Z lower-cased, nothing else."""
    return F.translate(text, _UPPER, _LOWER)


# Levels are kept as bytes: a substring of bytes needs no walk over characters.
def _slice(level: Column, start: Column, length: Column | int) -> Column:
    """``length`` digests from the 0-based ``start``, or what there is of them."""
    length = length if isinstance(length, Column) else F.lit(length)
    return F.substring(level, (start * WIDTH + 1).cast("int"), (length * WIDTH).cast("int"))


def _parents(level: Column) -> Column:
    """The next level: the digest of every run."""
    runs = F.ceil(F.length(level) / (ARITY * WIDTH)).cast("int")
    parents = F.transform(
        F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_slice(level, i * ARITY, ARITY), 256)
    )
    return F.array_join(parents, "").cast("binary")


def _siblings(level: Column, at: Column) -> Column:
    """What flanks digest ``at`` in its run, as a struct of two strings."""
    here = at % ARITY
    return F.struct(
        _slice(level, at - here, here).cast("string").alias("left"),
        _slice(level, at + 1, ARITY - 1 - here).cast("string").alias("right"),
    )


_PATH = "array<struct<left:string,right:string>>"


def _blocks(nodes: DataFrame, keys: list[str], items: list[str]) -> DataFrame:
    """A row per block of ``nodes`` (keys, position, node, items).

    Has the block's ``items`` in order, its levels, and ``up``: its last digest.
    Only a tree's first block can be alone in it; it climbs as far as its own
    nodes need. Every other one climbs all levels, since its tree goes on.
    """
    found = nodes.groupBy(*keys, F.expr(f"position div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("position", "node", *items))).alias("items")
    )
    alone = F.when(F.col("block") == 0, F.size("items")).otherwise(BLOCK)
    found = found.withColumn("level0", F.array_join(F.col("items.node"), "").cast("binary"))
    for level in range(1, LEVELS + 1):
        parents = _parents(F.col(f"level{level - 1}"))
        found = found.withColumn(f"level{level}", F.when(alone > ARITY ** (level - 1), parents))
    up = F.coalesce(*(f"level{level}" for level in range(LEVELS, -1, -1)))
    return found.withColumn("up", up.cast("string")).withColumn(
        "items", F.transform("items", lambda x: F.struct(x["position"], *(x[c] for c in items)))
    )


def climb(
    nodes: DataFrame, keys: list[str], items: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Every node's keys, position, node, items, ``path`` and ``top``, and each tree's ``top``.

    ``nodes`` has these columns but the last two; positions count from 0 in each
    tree, which ``keys`` name. A path is an array of flanks (left, right), from
    the node's run to the top, the last digest of the tree. Runs jobs: each
    tier's blocks are written, about two digests a node and for every further
    tier a 256th of that.
    """
    blocks = materialize(_blocks(nodes, keys, items))
    none = F.array().cast(_PATH)
    if blocks.where("block > 0").isEmpty():
        placed = blocks.select("*", none.alias("above"), F.col("up").alias("top"))
        tops = blocks.select(*keys, F.col("up").alias("top"))
    else:
        tier = blocks.select(*keys, F.col("block").alias("position"), F.col("up").alias("node"))
        ends, tops = climb(tier, keys, [])
        ends = ends.select(
            *(F.col(k).alias(f"_{k}") for k in keys),
            F.col("position").alias("_block"),
            F.col("path").alias("above"),
            "top",
        )
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        placed = blocks.join(ends, reduce(Column.__and__, same, F.col("block") == F.col("_block")))

    def with_path(x: Column) -> Column:
        at = (x["position"] % BLOCK).cast("int")
        steps = [
            F.when(
                F.col(f"level{level + 1}").isNotNull(),
                _siblings(F.col(f"level{level}"), F.floor(at / ARITY**level).cast("int")),
            )
            for level in range(LEVELS)
        ]
        return F.struct(
            x["position"].alias("position"),
            _slice(F.col("level0"), at, 1).cast("string").alias("node"),
            *(x[c].alias(c) for c in items),
            F.concat(F.array_compact(F.array(*steps)), F.col("above")).alias("path"),
        )

    placed = placed.select(*keys, "top", F.explode(F.transform("items", with_path)).alias("item"))
    return placed.select(*keys, "item.*", "top"), tops


def fold(node: Column, path: Column) -> Column:
    """The top that a node and the flanks of its path give."""
    return F.aggregate(path, node, lambda x, at: F.sha2(F.concat(at["left"], x, at["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """The manifest: a row per row of ``docs``, whose columns it shares by name.

    Returns doc_id, source, leaf, tampered_leaf, subroot (of its source), root (of
    all) and path (array of flanks from the leaf to the root). ``tampered_leaf`` is
    the leaf of the text with A-Z lower-cased where unsigned crc32 of the decimal
    doc_id is a multiple of 5, else null.

    Takes doc_id, source, lang, n_chars and text, and leaves others out. A null
    field has its own mark, so it differs from an empty one; the null source is a
    source and comes first. Rows of one source ascend by doc_id, null first, and
    rows that share it by leaf; repeated rows are leaves each. A null doc_id is
    never tampered with. An empty table gives no rows.

    Runs jobs: the numbering and each tier's blocks are written.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tamper = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf(*columns, F.col("text")).alias("node"),
        F.when(tamper, leaf(*columns, tampered_text(F.col("text")))).alias("tampered"),
    )
    placed = with_number_in_group(leaves, ["source"], ["doc_id", "node"], "number", "long")
    nodes = placed.select(
        "source", (F.col("number") - 1).alias("position"), "node", "doc_id", "tampered"
    )
    own, tops = climb(nodes, ["source"], ["doc_id", "tampered"])
    numbered = with_row_number(tops, [F.col("source").asc_nulls_first()], "number")
    subroots = numbered.select(
        (F.col("number") - 1).alias("position"), F.col("top").alias("node"), "source"
    )
    over, _ = climb(subroots, [], ["source"])
    over = over.select(
        F.col("source").alias("_source"), F.col("path").alias("_above"), F.col("top").alias("root")
    )
    return own.join(over, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        F.col("node").alias("leaf"),
        F.col("tampered").alias("tampered_leaf"),
        F.col("top").alias("subroot"),
        "root",
        F.concat("path", "_above").alias("path"),
    )


def verify(found: DataFrame) -> DataFrame:
    """A manifest's rows with their proof folded again.

    Adds proof_sha256 (digest of the path's siblings), folded_root (from the
    tampered leaf where there is one) and verified, whether that is the root.
    """
    siblings = F.transform("path", lambda at: F.concat(at["left"], at["right"]))
    start = F.coalesce("tampered_leaf", "leaf")
    return found.withColumns(
        {
            "proof_sha256": F.sha2(F.array_join(siblings, ""), 256),
            "folded_root": fold(start, F.col("path")),
        }
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
