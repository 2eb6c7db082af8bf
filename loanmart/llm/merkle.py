"""Merkle manifest of a table: a persistent tree per group, versions by path copying.

The rows of a group are its leaves, in the order of their ids; a tree over the groups' roots gives the root of
the table.  Trees are cut into aligned blocks of ``2 ** BLOCK_LEVELS`` nodes; a block is built in one task, the
tops of the blocks are the nodes of the next round, so no task holds more than a block, however large a
group is.  Every block learns the siblings above it (``climb``).

Nodes are never changed.  A tampered leaf makes a version of its block's tree: ``Block.change`` copies the leaf and its
ancestors and shares all other nodes; above the block the version goes on along the siblings of the block, which
all leaves below share, in whatever task holds the block.

Defined cases: NULL in a hashed column counts as ``-``; NULL groups are a group of their own, the first; rows without an
id come last in their group; rows with equal ids are in the order of their digests, equal rows are
leaves each; an empty table gives an empty result; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import map_arrow, store, table
from loanmart.operators.windows import add_index

BLOCK_LEVELS = 12
DIGEST = 64                                                 # digests are hexadecimal text


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


class Block:
    """Tree over ``leaves`` (digests) of ``levels`` levels above them; a node is its number.

    ``rows[l]``: nodes of level l of the first version.
    """

    def __init__(self, leaves: Sequence[bytes], levels: int):
        self.digests, self.children = list(leaves), [()] * len(leaves)
        self.rows = [list(range(len(leaves)))]
        for _ in range(levels):
            below = self.rows[-1]
            self.rows.append([self._add(tuple(below[i:i + 2])) for i in range(0, len(below), 2)])
        self.top = self.rows[-1][0]

    def _add(self, children: tuple[int, ...]) -> int:
        self.children.append(children)
        self.digests.append(digest(b"".join(self.digests[c] for c in children)))
        return len(self.digests) - 1

    def siblings(self, place: int) -> list[tuple[bytes, bool] | None]:
        """For each level from the leaf up the sibling's digest and whether it stands left; None if it has none."""
        out: list[tuple[bytes, bool] | None] = []
        for row in self.rows[:-1]:
            other = place ^ 1
            out.append((self.digests[row[other]], other < place) if other < len(row) else None)
            place >>= 1
        return out

    def change(self, place: int, leaf: bytes) -> list[int]:
        """A version with another leaf: its new nodes from the leaf to the top; all others are shared."""
        self.digests.append(leaf)
        self.children.append(())
        new = [len(self.digests) - 1]
        for row in self.rows[:-1]:
            other = place ^ 1
            pair = () if other >= len(row) else (row[other],)
            new.append(self._add((*pair, new[-1]) if other < place else (new[-1], *pair)))
            place >>= 1
        return new


def fold(node: bytes, siblings: Sequence[tuple[bytes, bool] | None]) -> list[bytes]:
    """Digests of the ancestors of ``node``, the nearest first."""
    out = []
    for s in siblings:
        node = digest(node if s is None else s[0] + node if s[1] else node + s[0])
        out.append(node)
    return out


def pack(siblings: Sequence[tuple[bytes, bool] | None]) -> bytes:
    return b"".join(b"-" if s is None else (b"<" if s[1] else b">") + s[0] for s in siblings)


def unpack(raw: bytes) -> list[tuple[bytes, bool] | None]:
    out: list[tuple[bytes, bool] | None] = []
    at = 0
    while at < len(raw):
        if raw[at:at + 1] == b"-":
            out.append(None)
            at += 1
        else:
            out.append((raw[at + 1:at + 1 + DIGEST], raw[at:at + 1] == b"<"))
            at += 1 + DIGEST
    return out


def levels_of(n: int, block_levels: int) -> int:
    """Levels above the leaves within a block of a tree of n leaves."""
    return min(block_levels, (n - 1).bit_length())


def _blocks(nodes: DataFrame, block_levels: int, more: str = "") -> DataFrame:
    """One row per block of ``nodes`` (tree, pos, n, digest, columns of ``more``): its nodes in order, and its top."""
    extra = [x.split()[0] for x in more.split(", ") if x]
    kinds = [x.split()[1] for x in more.split(", ") if x]

    def fn(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        n, leaves = t.column("n")[0].as_py(), [d.encode() for d in t.column("digest").to_pylist()]
        b = Block(leaves, levels_of(n, block_levels))
        row = {"tree": [t.column("tree")[0].as_py()], "block": [t.column("pos")[0].as_py() >> block_levels], "n": [n],
               "leaves": [b"".join(leaves)], "top": [b.digests[b.top].decode()]}
        cols = {k: pa.array(v, pa.int64() if k in ("block", "n") else pa.binary() if k == "leaves" else pa.string()) for k, v in row.items()}
        for c in extra:
            x = t.column(c).combine_chunks()
            x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
            cols[c] = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.table(cols)

    ddl = "tree string, block bigint, n bigint, leaves binary, top string" + "".join(
        f", {c} array<{k}>" for c, k in zip(extra, kinds))
    keyed = nodes.withColumn("block", F.shiftright("pos", block_levels))
    # dealt by block: a plan that is dealt by tree already would leave all blocks of a large group to one task
    return keyed.repartition("tree", "block").groupBy("tree", "block").applyInArrow(fn, ddl)


def climb(nodes: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(tree, pos, above, top): packed siblings from each node to the top of its tree.

    ``nodes``: tree, pos (0 to n - 1), n, digest.
    """
    blocks = store(_blocks(nodes, block_levels), "merkle-blocks")
    up = _above(blocks, block_levels)

    def fn(batches):
        for b in batches:
            out: dict[str, list] = {"tree": [], "pos": [], "above": [], "top": []}
            for r in b.to_pylist():
                leaves = [r["leaves"][i:i + DIGEST] for i in range(0, len(r["leaves"]), DIGEST)]
                block = Block(leaves, levels_of(r["n"], block_levels))
                for i in range(len(leaves)):
                    out["tree"].append(r["tree"])
                    out["pos"].append((r["block"] << block_levels) + i)
                    out["above"].append(pack(block.siblings(i)) + r["above"])
                    out["top"].append(r["end"])
            yield pa.RecordBatch.from_pydict(out, pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("above", pa.binary()),
                                                             ("top", pa.string())]))

    return map_arrow(up, fn, "tree string, pos bigint, above binary, top string")


def _above(blocks: DataFrame, block_levels: int) -> DataFrame:
    """``blocks`` with ``above`` (packed siblings above the block) and ``end`` (the tree's top)."""
    most = blocks.agg(F.max("n").alias("n")).first()["n"] or 0
    if most <= 1 << block_levels:
        return blocks.withColumns({"above": F.lit(b""), "end": F.col("top")})
    size = 1 << block_levels
    nodes = blocks.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
                          F.col("top").alias("digest"))
    up = store(climb(nodes, block_levels), "merkle-above").select(F.col("tree").alias("t"), F.col("pos").alias("p"), "above",
                                                                  F.col("top").alias("end"))
    return blocks.join(up, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("p"))).drop("t", "p")


def manifest(docs: DataFrame, id_col: str, group_col: str, leaf: Column, tampered: Column | None = None,
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``leaf``, ``position`` in the group, ``subroot``, ``root``, ``siblings`` (digests from
    the leaf to the root), ``copied`` (new nodes of the version that the tampered leaf makes, leaf and root included; NULL
    if there is none) and ``folded_root`` (computed from the tampered, else the original leaf and the siblings).

    ``leaf`` and ``tampered`` (NULL: not tampered) are digests as hexadecimal text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    group = F.col(f"`{group_col}`").cast("string")
    rows = docs.select(F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group)).alias("tree"),
                       F.col(f"`{id_col}`").alias("id"), leaf.alias("digest"),
                       (F.lit(None).cast("string") if tampered is None else tampered).alias("changed"),
                       F.monotonically_increasing_id().alias("equal"))     # parts equal rows, which may follow in any order
    rows = add_index(rows, order=["tree", "id", "digest", "equal"], name="at", start=0)
    trees = store(rows.groupBy("tree").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    placed = rows.join(trees, "tree").select("tree", (F.col("at") - F.col("first")).alias("pos"), "n", "digest", "id", "changed")
    blocks = store(_blocks(placed, block_levels, f"id {kind}, changed string"), "merkle-leaves")
    up = store(_above(blocks.drop("id", "changed", "leaves"), block_levels).select("tree", "block", "above", "end"), "merkle-ends")
    tops = add_index(up.filter("block = 0").select("tree", F.col("end").alias("digest")), order=["tree"], name="pos", start=0)
    over = climb(tops.select(F.lit("").alias("tree"), "pos", F.lit(tops.count()).cast("bigint").alias("n"), "digest"), block_levels)
    over = store(over.select(F.col("pos").alias("p"), F.col("above").alias("over"), F.col("top").alias("root")), "merkle-roots")
    ends = tops.join(over, F.col("pos") == F.col("p")).select(F.col("tree").alias("t"), "over", "root")
    up = up.join(ends, F.col("tree") == F.col("t")).select(
        F.col("tree").alias("t"), F.col("block").alias("p"), F.concat("above", "over").alias("above"), "end", "root")
    ready = blocks.join(up, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("p"))).drop("t", "p")
    names = ["id", "leaf", "position", "subroot", "root", "siblings", "copied", "folded_root"]
    ddl = (f"id {kind}, leaf string, position bigint, subroot string, root string, siblings array<string>, "
           "copied array<string>, folded_root string")

    def fn(batches):
        text, texts = pa.string(), pa.list_(pa.string())
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).drop_columns(["id"]).to_pylist()[0]
                leaves = [r["leaves"][i:i + DIGEST] for i in range(0, len(r["leaves"]), DIGEST)]
                yield _versions(b.column(b.schema.get_field_index("id"))[k].values, r, leaves, names, text, texts)

    def _versions(ids, r, leaves, names, text, texts):
        n = len(leaves)
        block, above = Block(leaves, levels_of(r["n"], block_levels)), unpack(r["above"])
        upper = [s[0].decode() for s in above if s]
        siblings, copied, folded = [], [], []
        for i, changed in enumerate(r["changed"]):
            inside = block.siblings(i)
            siblings.append([s[0].decode() for s in inside if s] + upper)
            if changed is None:
                copied.append(None)
                folded.append((fold(leaves[i], inside + above) or [leaves[i]])[-1].decode())
            else:
                new = [block.digests[x] for x in block.change(i, changed.encode())]
                new += fold(new[-1], above)
                copied.append([x.decode() for x in new])
                folded.append(new[-1].decode())
        first = r["block"] << block_levels
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([x.decode() for x in leaves], text), pa.array(range(first, first + n), pa.int64()), pa.array([r["end"]] * n, text),
             pa.array([r["root"]] * n, text), pa.array(siblings, texts), pa.array(copied, texts), pa.array(folded, text)], names=names)

    return map_arrow(ready, fn, ddl)


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def row_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` by language; tampered rows fail their proof."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    leaf = row_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    other = row_digest([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    done = manifest(docs, "doc_id", "lang", leaf, F.when(hit, other))
    return done.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels by a recursive query; siblings by parity; the fold goes up with the level.  crc32 bit by bit over the digits.
OP13_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, row_number() OVER () AS r,
         concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(length(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
                CASE WHEN source IS NULL THEN '-' ELSE concat(octet_length(encode(source)), ':', source) END,
                CASE WHEN lang IS NULL THEN '-' ELSE concat(octet_length(encode(lang)), ':', lang) END) AS a,
         n_chars, CASE WHEN text IS NULL THEN '-' ELSE concat(octet_length(encode(text)), ':', text) END AS z
  FROM documents),
crc AS (
  SELECT r, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
             range(1, length(CAST(doc_id AS VARCHAR)) + 1),
             lambda i: list_concat([CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)], list_transform(range(8), lambda j: CAST(-1 AS BIGINT)))))),
           lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END), 4294967295) AS c
  FROM d WHERE doc_id IS NOT NULL),
l AS (
  SELECT d.r, doc_id, lang, sha256(concat(a, CASE WHEN n_chars IS NULL THEN '-' ELSE concat(length(CAST(n_chars AS VARCHAR)), ':', n_chars) END, z)) AS leaf,
         CASE WHEN c % 7 = 0 THEN sha256(concat(a, CASE WHEN n_chars IS NULL THEN '-'
              ELSE concat(length(CAST(n_chars + 1 AS VARCHAR)), ':', n_chars + 1) END, z)) END AS other
  FROM d LEFT JOIN crc ON crc.r = d.r),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
low(lang, lev, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, n FROM p
  UNION ALL
  SELECT lang, any_value(lev) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY lang, pos // 2),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(lev, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM subs
  UNION ALL
  SELECT any_value(lev) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY pos // 2),
tops AS (SELECT h AS root FROM high WHERE n = 1),
height AS (SELECT lang, max(lev) AS lev FROM low GROUP BY lang),
steps AS (
  SELECT p.r, low.lev AS lev, low.pos < (p.pos >> low.lev) AS on_left, low.h FROM p
  JOIN low ON low.lang IS NOT DISTINCT FROM p.lang AND low.pos = xor(p.pos >> low.lev, 1)
  UNION ALL
  SELECT p.r, hl.lev + high.lev, high.pos < (subs.pos >> high.lev), high.h FROM p
  JOIN subs ON subs.lang IS NOT DISTINCT FROM p.lang JOIN height hl ON hl.lang IS NOT DISTINCT FROM p.lang
  JOIN high ON high.pos = xor(subs.pos >> high.lev, 1)),
tall AS (SELECT hl.lang, hl.lev + (SELECT max(lev) FROM high) AS h FROM height hl),
up(r, lev, h, tall) AS (
  SELECT p.r, 0, coalesce(p.other, p.leaf), tall.h FROM p JOIN tall ON tall.lang IS NOT DISTINCT FROM p.lang
  UNION ALL
  SELECT up.r, up.lev + 1, sha256(CASE WHEN s.h IS NULL THEN up.h WHEN s.on_left THEN s.h || up.h ELSE up.h || s.h END), up.tall
  FROM up LEFT JOIN steps s ON s.r = up.r AND s.lev = up.lev WHERE up.lev < up.tall),
proof AS (SELECT r, string_agg(h, '' ORDER BY lev) AS s FROM steps GROUP BY r)
SELECT p.doc_id, p.leaf, subs.subroot, tops.root, sha256(coalesce(proof.s, '')) AS proof_sha256, up.h AS folded_root, up.h = tops.root AS verified
FROM p CROSS JOIN tops JOIN subs ON subs.lang IS NOT DISTINCT FROM p.lang JOIN up ON up.r = p.r AND up.lev = up.tall LEFT JOIN proof ON proof.r = p.r
"""
