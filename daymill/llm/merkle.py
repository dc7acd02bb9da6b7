"""Merkle manifest of a dataset, with proofs of every leaf by pointer jumping. DataFrame operations only."""

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill import workspace
from daymill.llm.ranking import placed

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Ancestors whose segments take less than this, by their number and length, are broadcast; else both sides shuffle.
BROADCAST_BYTES = 16 << 20
HEX = 64  # characters of a digest

STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value so that no two rows run into the same text: `-` for null, else its UTF-8 bytes, `:`, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps give: each step's siblings stand left and right of what has been folded."""
    return F.aggregate(steps, leaf, lambda held, s: F.sha2(F.concat(s["left"], held, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _step(digests: Column, at: Column, alone: Column) -> Column:
    """The siblings left and right of place `at` (from 0) in a run, as steps; none for a node that is alone on its level."""
    left = F.array_join(F.slice(digests, F.lit(1), at), "")
    right = F.array_join(F.slice(digests, at + 2, F.size(digests)), "")
    return F.when(alone, F.array().cast(STEPS)).otherwise(F.array(F.struct(left.alias("left"), right.alias("right"))))


class Manifest:
    """A Merkle tree over the rows of a table: one subtree per group, one tree over the subroots, and all proofs.

    Leaves of a group ascend by id; while several nodes remain on a level, runs of FAN_OUT become the digest of their
    digests, and a node alone on its level goes up as it is. Subroots, ordered by group (null first, by bytes), likewise
    give the root.

    Proofs are made by pointer jumping. Every inner node starts with a pointer to its parent and the step to it, the
    siblings left and right of it. In each round the table is joined with itself: a node takes its ancestor's pointer and
    adds the ancestor's steps to its own, so distances double until all pointers are at the root. The children of a
    run share all but their first step, so leaves join their run's parent once, a row per run. Only nodes high enough to be
    an ancestor at the round's distance are on the right side; it is broadcast when their number and the length of their
    segments keep it below BROADCAST_BYTES, and shuffled else. Groups may be of any size and number: places
    come from ranges, levels and rounds are keyed by (group, place).

    Null groups are one group of their own; ids may be null (first) or repeat (then by digest; equal rows are a
    leaf each). `keep` names further columns to carry along with each leaf. An empty table has no leaves and the root None.
    Of `docs` only the named columns are read, so others may have any name.
    """

    def __init__(self, docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", fields=FIELDS, keep: dict[str, Column] | None = None):
        group = F.col(group_col).cast("string")
        self.id_col, self.group_col, self.keep = id_col, group_col, list(keep or {})
        kept = F.struct(*[c.alias(name) for name, c in (keep or {}).items()], F.lit(0).alias("_"))
        rows = docs.select(
            # Names of trees: null first, then by bytes; the tree of subroots is "".
            F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"), group.alias("grp"), F.col(id_col).alias("id"),
            leaf_digest(*[F.col(c) for c in fields]).alias("digest"), kept.alias("kept"),
        )
        # Texts are read once; what follows handles digests.
        leaves = placed(workspace.materialize(rows, "digests"), ["tree"], ["id", "digest"], "leaves")
        first = leaves.groupBy("tree", F.shiftright("place", 3).alias("up")).agg(
            F.first("group_size").alias("size"), F.first("grp").alias("grp"),
            F.array_sort(F.collect_list(F.struct(F.col("place").alias("idx"), "digest", "id", "kept"))).alias("kids"),
        )
        self.runs = workspace.materialize(first, "leaf-runs")
        # Two numbers: leaves of the largest group, and groups.
        largest, groups = self.runs.agg(F.max("size"), F.count_if(F.col("up") == 0)).first()
        self.depth, self.top_depth = _levels(largest or 0), _levels(groups)
        self.height = self.depth + self.top_depth
        self.nodes = workspace.materialize(self._nodes(), "nodes")
        self.counts = {r.h: r.n for r in self.nodes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).collect()}

    def _nodes(self) -> DataFrame:
        """Every inner node but the root: name (tree, h, idx), pointer to its parent, steps so far, and the digest where it
        is a subroot. Subroots have height `depth`, the nodes above them the heights after that."""
        runs, parts = self.runs, []
        for height in range(1, self.depth):
            runs = _runs(_parents(runs), height)
            parts.append(_nodes_of(runs, height, F.col("tree"), F.col("kid.idx"), F.lit(None).cast("string")))
        subroots = placed(_parents(runs).select("tree", "digest"), [], ["tree"], "subroots")
        numbered = subroots.select(
            F.lit("").alias("tree"), F.col("place").alias("idx"), F.col("group_size").alias("size"), "digest", F.col("tree").alias("own")
        )
        runs = _runs(numbered, self.depth, "own")
        parts.append(_nodes_of(runs, self.depth, F.col("kid.own"), F.lit(0).cast("long"), F.col("kid.digest")))
        for height in range(self.depth + 1, self.height):
            runs = _runs(_parents(runs), height)
            parts.append(_nodes_of(runs, height, F.col("tree"), F.col("kid.idx"), F.lit(None).cast("string")))
        root = _parents(runs).first()
        self.root = root and root.digest
        return reduce(DataFrame.unionByName, parts)

    def jumped(self) -> DataFrame:
        """(tree, idx, steps, sub) of the leaves' parents: their steps to the root, and their subroot."""
        nodes, distance = self.nodes, 1
        while distance < self.height - 1:
            above = nodes.filter(F.col("h") > distance).select(
                *[F.col(c).alias(f"a_{c}") for c in ("tree", "h", "idx", "steps", "sub")],
                *[F.col(f"up_{c}").alias(f"next_{c}") for c in ("tree", "h", "idx")],
            )
            bytes_ = sum(n for h, n in self.counts.items() if h > distance) * (distance * FAN_OUT * HEX + 500)
            if bytes_ <= BROADCAST_BYTES:
                above = F.broadcast(above)
            met = (F.col("up_tree") == F.col("a_tree")) & (F.col("up_h") == F.col("a_h")) & (F.col("up_idx") == F.col("a_idx"))
            distance *= 2
            # From here on only the leaves' parents jump, and what may be an ancestor at the next distance.
            needed = nodes.filter((F.col("h") == 1) | (F.col("h") > distance))
            joined = needed.join(above, met, "left").select(
                "tree", "h", "idx", *[F.col(f"next_{c}").alias(f"up_{c}") for c in ("tree", "h", "idx")],
                F.concat("steps", F.coalesce("a_steps", F.array().cast(STEPS))).alias("steps"), F.coalesce("sub", "a_sub").alias("sub"),
            )
            nodes = workspace.materialize(joined, f"jumped-{distance}")
        return nodes.filter("h = 1").select("tree", "idx", "steps", "sub")

    def proofs(self) -> DataFrame:
        """A row per leaf: id, group, leaf, subroot, root, steps (siblings left and right, from the leaf to the root),
        and the kept columns."""
        up = self.jumped().select(F.col("tree").alias("j_tree"), F.col("idx").alias("j_idx"), "steps", "sub")
        joined = self.runs.join(up, (F.col("tree") == F.col("j_tree")) & (F.col("up") == F.col("j_idx")))
        each = joined.select("grp", "size", "steps", "sub", F.col("kids.digest").alias("digests"), F.posexplode("kids").alias("at", "kid"))
        return each.select(
            F.col("kid.id").alias(self.id_col), F.col("grp").alias(self.group_col), F.col("kid.digest").alias("leaf"),
            F.col("sub").alias("subroot"), F.lit(self.root).cast("string").alias("root"), F.concat(_step(), "steps").alias("steps"),
            *[F.col("kid.kept")[c].alias(c) for c in self.keep],
        )


def _levels(n: int) -> int:
    """Levels above n leaves, one at least."""
    levels = 1
    while FAN_OUT**levels < n:
        levels += 1
    return levels


def _runs(nodes: DataFrame, height: int, *more: str) -> DataFrame:
    """Nodes (tree, idx, size of their level, digest) of one height in runs of FAN_OUT, stored."""
    kids = F.array_sort(F.collect_list(F.struct("idx", "digest", *more)))
    runs = nodes.groupBy("tree", F.shiftright("idx", 3).alias("up")).agg(F.first("size").alias("size"), kids.alias("kids"))
    return workspace.materialize(runs, f"runs-{height}")


def _parents(runs: DataFrame) -> DataFrame:
    """The nodes that runs become. A node alone on its level goes up as it is."""
    whole = F.sha2(F.array_join(F.col("kids.digest"), ""), 256)
    digest = F.when(F.col("size") == 1, F.col("kids")[0]["digest"]).otherwise(whole)
    return runs.select("tree", F.col("up").alias("idx"), F.ceil(F.col("size") / FAN_OUT).cast("long").alias("size"), digest.alias("digest"))


def _step() -> Column:
    """The siblings left and right of place `at` (from 0) in the run `digests`; no step for a node alone on its level."""
    left = F.array_join(F.slice("digests", F.lit(1), F.col("at")), "")
    right = F.array_join(F.slice("digests", F.col("at") + 2, F.size("digests")), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return F.when(F.col("size") == 1, F.array().cast(STEPS)).otherwise(step)


def _nodes_of(runs: DataFrame, height: int, tree: Column, idx: Column, sub: Column) -> DataFrame:
    """The nodes in runs of one height, each with a pointer to its parent and the step to it."""
    rows = runs.select("tree", "up", "size", F.col("kids.digest").alias("digests"), F.posexplode("kids").alias("at", "kid"))
    return rows.select(
        tree.alias("tree"), F.lit(height).alias("h"), idx.alias("idx"), F.col("tree").alias("up_tree"), F.lit(height + 1).alias("up_h"),
        F.col("up").alias("up_idx"), _step().alias("steps"), sub.alias("sub"),
    )


def oracle(levels: int = 7, top_levels: int = 2) -> str:
    """The query's rows in SQL, level by level, for up to 8 ** levels rows of a language and 8 ** top_levels languages."""
    def enc(c):
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def level(name, source, key):
        """Runs of a level: the parent's digest, and each node's siblings."""
        run = f"PARTITION BY {key}, i // 8 ORDER BY i"
        return f"""
    {name} AS (SELECT {key}, i, d, i // 8 AS up, count(*) OVER (PARTITION BY {key}) = 1 AS alone,
        coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {source}),
    {name}u AS (SELECT {key}, up AS i, CASE WHEN any_value(alone) THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
        FROM {name} GROUP BY {key}, up),"""

    small = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    head = " || ".join(enc(c) for c in FIELDS[:-1])
    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))"""
    sql = f"""
    WITH leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS t, sha256({head} || {enc("text")}) AS d,
        CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN sha256({head} || {enc(small)}) END AS tampered FROM documents),
    n0 AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM leaves),"""
    for k in range(levels):
        sql += level(f"l{k}", "n0" if k == 0 else f"l{k - 1}u", "t")
    sql += f"""
    s AS (SELECT t, d, row_number() OVER (ORDER BY t) - 1 AS i, 0 AS one FROM l{levels - 1}u),"""
    for k in range(top_levels):
        sql += level(f"m{k}", "s" if k == 0 else f"m{k - 1}u", "one")
    path = [f"l{k}" for k in range(levels)] + [f"m{k}" for k in range(top_levels)]
    joins = " ".join(f"JOIN l{k} ON l{k}.t = n0.t AND l{k}.i = n0.i // {8**k}" for k in range(levels))
    joins += " JOIN s ON s.t = n0.t " + " ".join(f"JOIN m{k} ON m{k}.i = s.i // {8**k}" for k in range(top_levels))
    sql += f"""
    p0 AS (SELECT n0.doc_id, n0.d AS leaf, s.d AS subroot, (SELECT d FROM m{top_levels - 1}u) AS root,
        {" || ".join(f"CASE WHEN {p}.alone THEN '' ELSE {p}.l || {p}.r END" for p in path)} AS siblings,
        coalesce(tampered, n0.d) AS f, {", ".join(f"{p}.alone AS a_{p}, {p}.l AS l_{p}, {p}.r AS r_{p}" for p in path)} FROM n0 {joins})"""
    for k, p in enumerate(path):
        sql += f""",
    p{k + 1} AS (SELECT * REPLACE (CASE WHEN a_{p} THEN f ELSE sha256(l_{p} || f || r_{p}) END AS f) FROM p{k})"""
    return sql + f"""
    SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, f AS folded_root, f = root AS verified FROM p{len(path)}"""
