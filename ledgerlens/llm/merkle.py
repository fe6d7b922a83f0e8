"""Merkle manifest of a table: leaves by group and key, runs of sixteen, proofs for every row.

Nodes are labelled with the half-open interval of the leaf ranks that they cover.  The node of
level ``k`` whose interval begins at ``lo`` lies in bucket ``lo // 16 ** (k + 1)`` of the level above, so
an ancestor is attached by a join on (group, bucket) that checks the containment of the intervals;
the siblings of a node are what its own interval leaves of its parent's.  Runs are built upwards,
each level a sixteenth of the one below; paths (the siblings left and right, level by level)
are handed down the same way, once for each run, so a leaf's path is made in its own run only.

Ranks come from a range partition by (group, key, digest, salt): positions in a part, and the number of
rows of the group in the parts before it.  No group is in one task, and rows that are equal in all are
split by the salt.

Digests are lowercase hexadecimal SHA-256 of concatenated strings.  Null keys come first; rows of one key
are ordered by their digest; equal rows are leaves of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.storage import stored

FANOUT = 16

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def row_digest(*values: Column) -> Column:
    """Digest of some values: each ``-`` if null, else its number of bytes in UTF-8, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Stored ``rows`` (stored ones, whose ``order`` tells all of them apart or does not matter) with
    ``lo`` (rank from 0 in the group) and ``n`` (rows of the group).  ``group`` is not null."""
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranked")
    parts = placed.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)  # a row for each part that the group is in
    parts = parts.select("_part", group, "_first", F.sum("_n").over(whole).alias("n"),
                         (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(parts, ["_part", group]).withColumn("lo", F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_part", "_at", "_first", "_before")


def _bucket(level: int) -> Column:
    """Of a node or run that begins at ``lo``, among the intervals of a level."""
    return F.floor(F.col("lo") / F.lit(FANOUT ** level)).cast("long").alias("bucket")


def runs_of(leaves: DataFrame, group: str, payload: list[str]) -> list[DataFrame]:
    """Runs of each level above the leaves (group, lo, n, digest and ``payload``): rows (group, n, lo, hi,
    digest, kids).  ``kids`` are the run's nodes (lo, hi, digest; the leaves' also have the payload).
    A group has levels as long as more than one node remains."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels = leaves.withColumn("hi", F.col("lo") + 1), []
    while FANOUT ** len(levels) < most:
        k = len(levels)
        kid = F.struct("lo", "hi", "digest", *(payload if k == 0 else []))
        runs = (nodes.where(F.col("n") > FANOUT ** k).groupBy(group, "n", _bucket(k + 1))
                .agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
        runs = stored(runs.select(group, "n", "lo", "hi", F.sha2(F.concat_ws("", "kids.digest"), 256).alias("digest"), "kids"), f"runs-{k + 1}")
        levels.append(runs)
        nodes = runs.drop("kids")
    return levels


def tops(leaves: DataFrame, runs: list[DataFrame], group: str) -> DataFrame:
    """(group, lo, digest) of the one node that remains of each group."""
    out = leaves.where("n = 1").select(group, "lo", "digest")
    for k, level in enumerate(runs, start=1):
        out = out.unionByName(level.where(F.col("n") <= FANOUT ** k).select(group, "lo", "digest"))
    return out


def _siblings(kids: Column, node: Column) -> Column:
    """What the node's interval leaves of its parent's, as digests left and right."""
    def joined(side) -> Column:
        return F.concat_ws("", F.transform(F.filter(kids, side), lambda x: x["digest"]))

    return F.struct(joined(lambda x: x["hi"] <= node["lo"]).alias("left"), joined(lambda x: x["lo"] >= node["hi"]).alias("right"))


def paths(leaves: DataFrame, runs: list[DataFrame], group: str, payload: list[str], above: DataFrame, carried: list[str]) -> DataFrame:
    """``payload``, ``digest``, ``carried`` and ``path`` of all leaves.  ``above`` gives the ``path`` of each group's
    top and columns to carry down.  ``path`` begins at the leaf: (left, right) digests of its siblings for each level."""
    nodes = None  # of level k, with paths
    for k in range(len(runs), -1, -1):
        # tops of this level get what is above
        own = runs[k - 1].drop("kids") if k else leaves.withColumn("hi", F.col("lo") + 1)
        ends = own.where(F.col("n") <= FANOUT ** k).join(above, group).select(
            group, "lo", "hi", "digest", "path", *carried, *(payload if k == 0 else []))
        nodes = ends if nodes is None else nodes.unionByName(ends)
        if k:
            ancestors = nodes.select(group, _bucket(k), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", *carried)
            inside = runs[k - 1].select(group, _bucket(k), "lo", "hi", "kids").join(ancestors, [group, "bucket"]).where(
                "_lo <= lo and hi <= _hi")
            each = inside.select(group, "kids", "path", *carried, F.explode("kids").alias("kid"))
            nodes = each.select(group, "kid.lo", "kid.hi", "kid.digest", *carried, *([f"kid.{c}" for c in payload] if k == 1 else []),
                                F.concat(F.array(_siblings(F.col("kids"), F.col("kid"))), F.col("path")).alias("path"))
    return nodes.select(*payload, "digest", "path", *carried)


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all sibling digests of a path."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"]))), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text with its A-Z lower-cased where 5 divides the crc32 of the decimal doc_id; a null doc_id's stays."""
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(hit, F.translate(text, CAPITALS, SMALL)).otherwise(text)


def verified_manifest(docs: DataFrame, columns: list[str], key: str = "doc_id", group: str = "source",
                      tampered: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, subroot, root, path, folded_root, verified) of each row of ``docs``.

    A leaf is the digest of ``columns``; the leaves of a group ascend by ``key``, sixteen consecutive nodes become
    one until one remains (the subroot), and the subroots, in order of the group (null first), likewise
    give the root.  ``tampered`` replaces columns in the leaf that ``folded_root`` is recomputed from.
    Null keys, groups and values are kept; other columns are not read; an empty table gives no rows."""
    changed = [(tampered or {}).get(c, F.col(c)) for c in columns]
    leaf = row_digest(*map(F.col, columns))
    spark = docs.sparkSession
    # a name that sorts as the group does: null before all others
    name = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    rows = stored(docs.select(name.alias("_g"), F.col(key).alias("_key"), leaf.alias("digest"), row_digest(*changed).alias("_tampered"),
                              F.rand().alias("_salt")), "leaves")
    payload = ["_key", "_tampered"]
    leaves = stored(ranked(rows, "_g", ["_key", "digest", "_salt"]).drop("_salt"), "ranked-leaves")
    runs = runs_of(leaves, "_g", payload)

    groups = stored(tops(leaves, runs, "_g").select(F.lit("").alias("_all"), "_g", "digest"), "subroots")
    subroots = stored(ranked(groups, "_all", ["_g"]), "ranked-subroots")
    upper = runs_of(subroots, "_all", ["_g"])
    top = tops(subroots, upper, "_all").first()
    out = f"`{key}` {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, " \
          "path array<struct<left: string, right: string>>, folded_root string, verified boolean"
    if top is None:
        return spark.createDataFrame([], out)
    start = spark.createDataFrame([("", [])], "_all string, path array<struct<left: string, right: string>>")
    above = stored(paths(subroots, upper, "_all", ["_g"], start, []).withColumnRenamed("digest", "subroot"), "subroot-paths")
    found = paths(leaves, runs, "_g", payload, above, ["subroot"])
    root = F.lit(top["digest"])
    found = found.withColumn("folded_root", folded(F.col("_tampered"), F.col("path")))
    return found.select(F.col("_key").alias(key), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path", "folded_root",
                        (F.col("folded_root") == root).alias("verified"))


# --- the same in SQL ---------------------------------------------------------------
def manifest_sql(levels: int = 10) -> str:
    """DuckDB SQL of the ``documents`` manifest, for groups of up to 16 ** levels rows."""
    crc = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: CAST(ascii(c) AS BIGINT))), lambda r, b: list_reduce(list_concat([xor(r, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))")

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
                                       for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    ctes = [f"""raw AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g, {digest('text')} AS leaf,
              {digest('lowered')} AS tampered FROM (SELECT *, CASE WHEN {crc} % 5 = 0 THEN translate(text, '{CAPITALS}', '{SMALL}')
              ELSE text END AS lowered FROM documents))""",
            """leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j,
              count(*) OVER (PARTITION BY g) AS n FROM raw)""",
            "a0 AS (SELECT g, j, leaf AS digest, n FROM leaves)"]

    def tree(t: str) -> None:
        for k in range(levels):
            ctes.append(f"""{t}l{k} AS (SELECT g, j // 16 AS run, n, list(digest ORDER BY j) AS kids FROM {t}{k}
                         WHERE n > {16 ** k} GROUP BY g, j // 16, n)""")
            ctes.append(f"{t}{k + 1} AS (SELECT g, run AS j, sha256(array_to_string(kids, '')) AS digest, n FROM {t}l{k})")
        ctes.append(f"{t}top AS (" + " UNION ALL ".join(
            f"SELECT g, digest FROM {t}{k} WHERE n <= {16 ** k}" for k in range(levels + 1)) + ")")

    tree("a")
    ctes.append("b0 AS (SELECT 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS j, digest, count(*) OVER () AS n FROM atop)")
    ctes.append("place AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS j, count(*) OVER () AS n FROM atop)")
    tree("b")
    ctes.append("s0 AS (SELECT l.doc_id, l.leaf, p.subroot, l.g, l.j, l.n, p.j AS pj, p.n AS pn, l.tampered AS acc, '' AS proof "
                "FROM leaves l JOIN place p ON l.g = p.g)")
    step = 0
    for t, key, j, n in (("a", "s.g", "j", "n"), ("b", "'all'", "pj", "pn")):
        for k in range(levels):
            at = f"(s.{j} // {16 ** k}) % 16"
            left, right = f"array_to_string(l.kids[1:{at}], '')", f"array_to_string(l.kids[{at} + 2:], '')"
            ctes.append(f"""s{step + 1} AS (SELECT s.* REPLACE (
                CASE WHEN l.g IS NULL THEN s.acc ELSE sha256({left} || s.acc || {right}) END AS acc,
                CASE WHEN l.g IS NULL THEN s.proof ELSE s.proof || {left} || {right} END AS proof)
                FROM s{step} s LEFT JOIN {t}l{k} l ON l.g = {key} AND l.run = s.{j} // {16 ** (k + 1)})""")
            step += 1
    return ("WITH " + ",\n".join(ctes) + f"""
        SELECT s.doc_id, s.leaf, s.subroot, b.digest AS root, sha256(s.proof) AS proof_sha256, s.acc AS folded_root,
        s.acc = b.digest AS verified FROM s{step} s, btop b""")
