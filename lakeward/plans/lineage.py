"""Erasure by contract: which tables hold a subject, found from the contracts alone.

The contracts form a graph.  A product has its source behind it (the bronze
table that its runs land, or the table of another product), a quarantine beside
it and the staged output of runs that were blocked or lost.  A table holds a
subject where it has a column of one: a field marked ``pii``, or a field of a downstream
contract that carries on such a column of its source (under the same name, or as
``pseudonymized_<name>``).  A product downstream of a subject table without such a
column is a rollup: its rows fed by erased ones are computed anew.

One request is one table of hits: a row for each (table, column, partition, subject).  It is
stored before anything changes, and all that follows reads it: the audit, the
partitions to rewrite, the keys of the rollups.  So a request that was interrupted is
done again under its id and ends as if it had run once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.expressions import pseudonym
from lakeward.model import ContractError, Product
from lakeward.operators import joins
from lakeward.plans.runner import apply_steps, read_source
from lakeward.sinks import writes

HITS = "table_name string, `column` string, part string, subject string, rows bigint"
AUDIT = "subject string, table_name string, `column` string, rows_erased bigint, requested_at timestamp, request_id string"


@dataclass(frozen=True)
class Node:
    """A table of the graph.  ``columns``: its subject columns with whether they hold raw ids; none for a rollup."""
    table: str
    path: str
    product: Product
    parents: tuple
    columns: tuple
    partition_by: tuple
    fmt: str = "parquet"
    cluster_by: tuple = ()

    @property
    def rollup(self) -> bool:
        return not self.columns


def _ordered(products: list[Product]) -> list[Product]:
    """Products after the products that their sources name; a circle is a contract error."""
    by_table = {f"{t}.{p.name}": p for p in products for t in ("silver", "gold") if p.tier(t).enabled}
    out, open_ = [], []

    def visit(p):
        if p in out:
            return
        if p in open_:
            raise ContractError(f"sources go in a circle: {' -> '.join(x.name for x in [*open_, p])}")
        open_.append(p)
        if p.source.get("table") in by_table:
            visit(by_table[p.source["table"]])
        open_.remove(p)
        out.append(p)

    for p in products:
        visit(p)
    return out


def _staged(spark: SparkSession, root: str, folder: str) -> list[str]:
    """Runs that left a staged table of a product (a listing of folder names)."""
    fs, p = writes._fs(spark, f"{root}/_staging/{folder}")
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []


def graph(spark: SparkSession, root: str, products: list[Product]) -> list[Node]:
    """V3: the tables below ``root`` that the contracts make subjects reach, each after those it is derived from."""
    nodes, reached = [], {}
    for p in _ordered(products):
        hashed = {s.params["column"] for s in p.steps if s.type == "hash"}
        source = p.source.get("table")
        above = reached.get(source, {})
        # a pii column that its contract does not hash is raw unless the source had hashed it
        own = {c: c not in hashed and not (c in above and not above[c]) for c in p.pii_columns()}
        for c, is_raw in above.items():
            own.update({f.name: is_raw and f.name not in hashed for f in p.fields
                        if f.name in (c, f"pseudonymized_{c}") and f.name not in own})
        if not own and source not in reached:
            continue                                    # no subject ever gets here
        bronze = p.tier("bronze")
        raw = tuple((c, True) for c in p.pii_columns())
        parents = (source,) if source else ()
        if bronze.enabled and raw:
            b = Node(f"bronze.{p.name}", f"{root}/bronze/{p.name}", p, (), raw, bronze.partition_by, bronze.format)
            nodes.append(b)
            nodes += [Node(f"staging.bronze.{p.name}/{r}", f"{root}/_staging/bronze/{p.name}/{r}", p, (b.table,), raw,
                           bronze.partition_by, bronze.format) for r in _staged(spark, root, f"bronze/{p.name}")]
            parents = (b.table,)
        if p.pii_columns():                             # the runner hashes all of them on their way to quarantine
            nodes.append(Node(f"quarantine.{p.name}", f"{root}/quarantine/contract={p.name}", p, parents,
                              tuple((c, False) for c in p.pii_columns()), ("step", "run_id")))
        for tier in ("silver", "gold"):
            t = p.tier(tier)
            if not t.enabled:
                continue
            table = f"{tier}.{p.name}"
            reached[table] = own
            nodes.append(Node(table, f"{root}/{tier}/{p.name}", p, parents, tuple(own.items()), t.partition_by, t.format,
                              t.z_order_by))
            if own:
                nodes += [Node(f"staging.{p.name}/{r}", f"{root}/_staging/{p.name}/{r}", p, parents, tuple(own.items()),
                               t.partition_by, t.format) for r in _staged(spark, root, p.name)]
    return nodes


def _schema(spark: SparkSession, n: Node) -> T.StructType | None:
    """All columns that a table's files have, or None without files; for partition columns the contract's types go before
    what folder names look like."""
    if not writes.exists(spark, n.path) or not writes._data_files(*writes._fs(spark, n.path)):
        return None
    declared = {f.name: f.dataType for f in T.StructType.fromDDL(n.product.ddl())}
    found = spark.read.format(n.fmt).option("mergeSchema", "true").load(n.path).schema
    kind = lambda c: declared.get(c) or (T.DateType() if c.endswith("_date") else T.StringType())
    return T.StructType([T.StructField(f.name, kind(f.name) if f.name in n.partition_by else f.dataType) for f in found])


def _read(spark: SparkSession, n: Node, schemas: dict) -> DataFrame:
    return spark.read.format(n.fmt).schema(schemas[n.table]).load(n.path)


def _part(n: Node):
    return F.to_json(F.struct(*n.partition_by)) if n.partition_by else F.lit("{}")


def _key(column: str, raw: bool, salt: str):
    return pseudonym(column, salt) if raw else F.col(column)


def _subjects(keys: DataFrame) -> DataFrame:
    return joins.bounded_broadcast(keys.select(F.col("subject").alias("__s")).where(F.col("__s").isNotNull()).distinct())


def find(spark: SparkSession, nodes: list[Node], subjects: DataFrame, salt: str, schemas: dict) -> DataFrame:
    """The hits of the subjects (``HITS``): every subject table read once a column, its subject and partition columns alone."""
    out = spark.createDataFrame([], HITS)
    for n in (n for n in nodes if n.table in schemas):
        for c, raw in n.columns:
            found = (_read(spark, n, schemas).select(_key(c, raw, salt).alias("subject"), _part(n).alias("part"))
                     .join(subjects, F.col("subject") == F.col("__s"), "left_semi"))
            out = out.unionByName(found.groupBy("part", "subject").agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(n.table).alias("table_name"), F.lit(c).alias("column"), "part", "subject", "rows"))
    return out


def _stored(spark: SparkSession, path: str, make, schema) -> DataFrame:
    """``make()`` stored at ``path`` by the first try of a request that got through with it."""
    if not writes.exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _without(df: DataFrame, n: Node, subjects: DataFrame, salt: str) -> DataFrame:
    """Rows of no subject in any subject column; a NULL id is no subject's, so its row stays."""
    for c, raw in n.columns:
        df = df.join(subjects, _key(c, raw, salt) == F.col("__s"), "left_anti")
    return df


def _of(df: DataFrame, n: Node, subjects: DataFrame, salt: str) -> DataFrame:
    """Rows of a subject in some subject column, each once."""
    hit = F.lit(False)
    cols = df.columns
    for i, (c, raw) in enumerate(n.columns):
        s = subjects.select(F.col("__s").alias(f"__s{i}"))
        df = df.join(s, _key(c, raw, salt) == F.col(f"__s{i}"), "left")
        hit = hit | F.col(f"__s{i}").isNotNull()
    return df.where(hit).select(*cols)


def _touched(hits: DataFrame, n: Node, schema: T.StructType) -> list[tuple]:
    """Partitions of a table with hits: one row a folder."""
    rows = hits.where(F.col("table_name") == n.table).select("part").distinct()
    if not n.partition_by:
        return [()] if rows.take(1) else []
    fields = T.StructType([schema[c] for c in n.partition_by])
    return sorted({tuple(r[0]) for r in rows.select(F.from_json("part", fields)).collect()}, key=str)


def erase(spark: SparkSession, root: str, products: list[Product], keys: DataFrame, salt: str, as_of: str,
          request_id: str, refs: dict | None = None) -> DataFrame:
    """Erase ``keys`` (pseudonyms in ``subject``; see ``erasure.subjects``) from all tables the contracts reach and
    compute the rollups anew.  Returns the request's audit rows, which alone keep the pseudonyms.  No other
    writer may be at work on the tables."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", request_id):
        raise ValueError(f"request id {request_id!r} may hold letters, digits, dots, dashes and underscores only")
    nodes = graph(spark, root, products)
    held, audit = f"{root}/_requests/{request_id}", f"{root}/_audit/erasures"
    for n in nodes:
        writes.restore(spark, n.path)
    schemas = {n.table: s for n in nodes if (s := _schema(spark, n)) is not None}
    nodes = [n for n in nodes if n.table in schemas]
    subjects = _subjects(keys)
    hits = _stored(spark, f"{held}/hits", lambda: find(spark, nodes, subjects, salt, schemas), HITS)

    parts, fed = {}, {}     # table -> touched partitions; rollup -> its key columns and the stored keys to compute anew
    changing = {}           # table -> those of its rows that are about to change
    for n in nodes:
        df = _read(spark, n, schemas)
        if not n.rollup:
            parts[n.table] = _touched(hits, n, schemas[n.table])
            if parts[n.table]:
                here = writes._in_partitions(df, list(n.partition_by), parts[n.table]) if n.partition_by else df
                changing[n.table] = _of(here, n, subjects, salt)
        elif n.parents[0] in changing:
            on = list(_merge(n.product)["match_on"])
            kinds = T.StructType([schemas[n.table][c] for c in on])
            # the rows that feed a rollup row give its key when they go through the contract's own steps
            keyed = apply_steps(spark, changing[n.parents[0]], n.product, salt, as_of, refs)[0]
            fed[n.table] = on, _stored(spark, f"{held}/keys-{n.table}", lambda: keyed.select(
                *[F.col(c).cast(kinds[c].dataType) for c in on]).distinct(), kinds)
            changing[n.table] = df.join(fed[n.table][1], on, "left_semi")

    for n in nodes:
        if parts.get(n.table):
            df = _read(spark, n, schemas)
            if n.partition_by:
                rest = _without(writes._in_partitions(df, list(n.partition_by), parts[n.table]), n, subjects, salt)
                writes.replace_partitions(spark, rest, n.path, list(n.partition_by), parts[n.table], n.fmt, n.cluster_by)
            else:
                writes.replace_table(spark, _without(df, n, subjects, salt), n.path, n.fmt, n.cluster_by)
        elif n.table in fed:
            _recompute(spark, root, n, products, *fed[n.table], schemas[n.table], salt, as_of, refs)

    left = find(spark, nodes, subjects, salt, schemas).select("table_name").distinct().collect()        # at most one row a table
    if left:
        raise writes.MoveError(f"rows of request {request_id} are left in {sorted(r[0] for r in left)}")
    (hits.groupBy("subject", "table_name", "column").agg(F.sum("rows").alias("rows_erased"))
     .withColumn("requested_at", F.lit(as_of).cast("timestamp")).write.mode("overwrite").parquet(f"{audit}/request_id={request_id}"))
    writes.discard(spark, held)
    return spark.read.schema(AUDIT).parquet(audit).where(F.col("request_id") == request_id)


def _merge(p: Product) -> dict:
    step = next((s for s in p.steps if s.type == "merge"), None)
    if step is None:
        raise ContractError(f"{p.name} holds rows made of subjects' rows but has no merge step that names its keys")
    return step.params


def _recompute(spark, root, n: Node, products, on, keys, schema, salt, as_of, refs) -> None:
    """The rows of a rollup under ``keys`` from what its source holds now; ``fed_by`` of the merge step names the source
    columns that key columns are equal to, which prunes the source to the partitions behind the keys."""
    source = read_source(spark, n.product, root, products)
    for key, column in (_merge(n.product).get("fed_by") or {}).items():
        source = writes._of_values(source, keys.select(F.col(key).alias(column)), [column])
    fresh = apply_steps(spark, source, n.product, salt, as_of, refs)[0].join(keys, on, "left_semi")
    writes.replace_keys(spark, n.path, fresh.select(*schema.names), keys, on, list(n.partition_by), schema, n.fmt)
