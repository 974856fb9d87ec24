"""Lineage input tables derived from the driver's ``orders`` and ``lineitem``.

The projections are deterministic and run unchanged on Spark SQL and DuckDB:
Spark builds the tables from the parquet files (so the work grows with the
data), and the DuckDB oracle inlines the same text as CTEs. ``{name}``
placeholders name either a base table or an earlier fixture ``fx_<name>``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# The fixture projections (same text for Spark and DuckDB).
FIXTURE_SQL: dict[str, str] = {
    "executions": """
select o_orderkey as execution_id,
       'app_' || cast(o_custkey % 50 as string) as app_name,
       'local[' || cast(1 + o_custkey % 50 % 4 as string) || ']' as master,
       'save at job_' || cast(o_orderkey % 37 as string) as description,
       case when o_orderkey % 211 = 5 then null else o_orderdate end as started_at,
       case when o_custkey % 50 = 49 then null
            when o_custkey % 50 % 10 < 3 then 'hdfs://stagcluster'
            else 'hdfs://prodcluster' end as default_fs,
       case when o_custkey % 50 % 5 = 1 then 'hdfs://prodcluster/in/' else '' end as input_override,
       case when o_custkey % 50 % 7 = 2 then 'hdfs://prodcluster/out/' else '' end as output_override
from {orders}
""",
    "plan_nodes": """
with roots as (
  select o_orderkey as execution_id, o_orderkey % 10 as k,
         'd' || cast(o_custkey % 5 as string) as db,
         't' || cast(o_orderkey % 200 as string) as tbl
  from {orders} where o_orderkey % 97 <> 0
), kids as (
  select l_orderkey as execution_id, l_orderkey % 10 as rk, l_partkey % 8 as ck,
         cast(row_number() over (partition by l_orderkey
              order by l_linenumber, l_partkey, l_suppkey) as int) as node_id,
         case when l_suppkey % 9 = 0 then 'salesdb' else 'd' || cast(l_partkey % 5 as string) end as db,
         't' || cast(l_partkey % 200 as string) as tbl,
         l_suppkey as sk
  from {lineitem} where l_orderkey % 97 <> 0
)
select execution_id, 0 as node_id, cast(null as int) as parent_id, 'root' as edge_kind,
       case when k <= 2 then 'InsertIntoHadoopFsRelationCommand'
            when k in (3, 9) then 'SaveIntoDataSourceCommand'
            when k = 4 then 'InsertIntoHiveTable'
            when k = 5 then 'CreateHiveTableAsSelectCommand'
            when k = 6 then 'CreateDataSourceTableAsSelectCommand'
            when k = 7 then 'GlobalLimit'
            else 'HiveTableRelation' end as node_class,
       cast(null as string) as relation_class,
       case when k in (2, 4, 8) then db end as catalog_db,
       case when k in (2, 4, 5, 8) then tbl end as catalog_table,
       case when k <= 2 then 'hdfs://prodcluster/out/' || db || '/' || tbl end as path,
       case when k = 3 then 'jdbc:sqlserver://;serverName=dbhost'
            when k = 9 then 'jdbc:mysql://dbhost:3306/shop' end as jdbc_url,
       case when k = 3 then db || '.dbo.' || tbl
            when k = 9 and execution_id % 20 = 9 then db || '.' || tbl end as jdbc_table,
       case when k <= 2 then split('hdfs://prodcluster/out/' || db || '/' || tbl, ',') end as paths
from roots
union all
select execution_id, node_id, 0 as parent_id,
       case when rk in (3, 9) then 'inner_query' else 'child' end as edge_kind,
       case when ck <= 4 then 'LogicalRelation' when ck = 5 then 'HiveTableRelation'
            when ck = 6 then 'InMemoryRelation' else 'Join' end as node_class,
       case when ck <= 2 then 'HadoopFsRelation' when ck <= 4 then 'JDBCRelation' end as relation_class,
       case when ck in (2, 5) then db end as catalog_db,
       case when ck in (2, 5) then tbl end as catalog_table,
       case when ck = 0 and sk % 10 = 0 then 'hdfs://prodcluster/archive/' || db || '/' || tbl
            when ck = 0 then 'hdfs://prodcluster/data/' || db || '/' || tbl || '.csv'
            when ck <= 2 then 'hdfs://prodcluster/warehouse/hive/' || db || '.db/' || tbl end as path,
       case when ck = 3 then 'jdbc:mysql://dbhost:3306/shop'
            when ck = 4 then 'jdbc:sqlserver://;serverName=dbhost' end as jdbc_url,
       case when ck in (3, 4) and sk % 25 <> 0 then db || '.' || tbl end as jdbc_table,
       case when ck = 0 and sk % 10 = 0 then split('hdfs://prodcluster/archive/' || db || '/' || tbl, ',')
            when ck = 0 and sk % 10 = 1 then split('hdfs://prodcluster/data/' || db || '/' || tbl || '.csv'
                                                   || ',hdfs://prodcluster/more/' || tbl, ',')
            when ck = 0 then split('hdfs://prodcluster/data/' || db || '/' || tbl || '.csv', ',')
            when ck = 1 and sk % 7 = 0 then split('hdfs://prodcluster/warehouse/hive/' || db || '.db/' || tbl
                                                  || ',hdfs://prodcluster/warehouse/hive/' || db || '.db/' || tbl || '_b', ',')
            when ck <= 2 then split('hdfs://prodcluster/warehouse/hive/' || db || '.db/' || tbl, ',') end as paths
from kids where rk <> 8
union all
select execution_id, node_id + 100, node_id as parent_id, 'cached' as edge_kind,
       case sk % 5 when 0 then 'FileSourceScanExec' when 1 then 'RowDataSourceScanExec'
            when 2 then 'InMemoryTableScanExec' when 3 then 'HiveTableScanExec'
            else 'LocalTableScanExec' end as node_class,
       case sk % 5 when 0 then 'HadoopFsRelation' when 1 then 'JDBCRelation' end as relation_class,
       case when sk % 5 = 3 then db end as catalog_db,
       case when sk % 5 = 3 then tbl end as catalog_table,
       case when sk % 5 = 0 then 'hdfs://prodcluster/data/' || db || '/' || tbl || '.csv' end as path,
       case when sk % 5 = 1 then 'jdbc:mysql://dbhost:3306/shop' end as jdbc_url,
       case when sk % 5 = 1 then db || '.' || tbl end as jdbc_table,
       case when sk % 5 = 0 then split('hdfs://prodcluster/data/' || db || '/' || tbl || '.csv', ',') end as paths
from kids where rk <> 8 and ck = 6
union all
select execution_id, node_id + 200, node_id + 100 as parent_id, 'cached' as edge_kind,
       'FileSourceScanExec' as node_class, 'HadoopFsRelation' as relation_class,
       cast(null as string) as catalog_db, cast(null as string) as catalog_table,
       'hdfs://prodcluster/nested/' || db || '/' || tbl as path,
       cast(null as string) as jdbc_url, cast(null as string) as jdbc_table,
       split('hdfs://prodcluster/nested/' || db || '/' || tbl, ',') as paths
from kids where rk <> 8 and ck = 6 and sk % 5 = 2
""",
    "plan_columns": """
with types as (select * from (values (0, 'void'), (1, 'date'), (2, 'interval'), (3, 'timestamp'),
  (4, 'tinyint'), (5, 'binary'), (6, 'boolean'), (7, 'int'), (8, 'bigint'), (9, 'double'),
  (10, 'float'), (11, 'smallint'), (12, 'string'), (13, 'decimal(12,2)'), (14, 'array<int>')) as t(tk, data_type)),
kids as (
  select l_orderkey as execution_id, l_orderkey % 10 as rk, l_partkey % 8 as ck, l_partkey as pk, l_suppkey as sk,
         cast(row_number() over (partition by l_orderkey
              order by l_linenumber, l_partkey, l_suppkey) as int) as node_id
  from {lineitem} where l_orderkey % 97 <> 0
)
select execution_id,
       case when ck = 6 and sk % 5 = 2 then node_id + 200
            when ck = 6 then node_id + 100 else node_id end as node_id,
       cast(ordinal as int) as ordinal,
       'c' || cast((pk + ordinal) % 20 as string) as column_text, data_type
from (select *, {ordinals} as ordinal from kids) kids3 join types on tk = (sk + ordinal) % 15
where rk <> 8 and ck <= 6 and not (ck = 6 and sk % 5 = 4)
union all
select o_orderkey as execution_id, 0 as node_id, cast(ordinal as int) as ordinal,
       'c' || cast((o_custkey + ordinal * 3) % 25 as string) || '#' || cast(o_orderkey + ordinal as string) as column_text,
       cast(null as string) as data_type
from (select *, {ordinals} as ordinal from {orders}) orders3
where o_orderkey % 97 <> 0 and o_orderkey % 10 <= 2
""",
    "runs": """
select execution_id, app_name, master, started_at, run_no,
       cast(row_number() over (partition by app_name, run_no order by started_at nulls first, execution_id) - 1 as bigint) as run_execution_id
from (select e.*, case when started_at < timestamp '1998-07-01 00:00:00' then 1 else 2 end as run_no
      from {fx_executions} e) x
""",
    "relationships": """
select 'urn:li:dataFlow:(spark,' || app_name || ',' || master || ')' as entity_urn,
       'urn:li:dataJob:(urn:li:dataFlow:(spark,' || app_name || ',' || master || '),ExecutionId_' || cast(run_execution_id as string) || ')' as related_urn,
       'IsPartOf' as rel_type,
       case when run_execution_id % 11 = 10 then 'OUTGOING' else 'INCOMING' end as direction
from {fx_runs} where run_no = 1
""",
    "flow_status": """
select 'urn:li:dataFlow:(spark,' || app_name || ',' || master || ')' as urn, 1 as seq, true as removed
from {fx_executions} where cast(substring(app_name, 5) as int) % 3 = 0 group by app_name, master
union all
select 'urn:li:dataFlow:(spark,' || app_name || ',' || master || ')' as urn, 2 as seq, false as removed
from {fx_executions} where cast(substring(app_name, 5) as int) % 6 = 0 group by app_name, master
""",
}

# Run boundary of the two-run catalog scenario (fixed value of the fixture).
RUN_SPLIT = "1998-07-01 00:00:00"

# Three rows per row: the engines name the same function differently.
ORDINALS = "{ordinals}"
SPARK_ORDINALS = "explode(array(0, 1, 2))"
DUCKDB_ORDINALS = "unnest([0, 1, 2])"
# Spark joins the 15 types by a copy in every task: their key would deal all
# columns to 15 tasks at most.
SPARK_HINTS = {"plan_columns": ("\nselect execution_id,", "\nselect /*+ broadcast(types) */ execution_id,")}

_PLACEHOLDER = re.compile(r"\{(?!ordinals\})(\w+)\}")


def dependencies(name: str) -> list[str]:
    """Names a fixture refers to, in order of first use."""
    seen: list[str] = []
    for ref in _PLACEHOLDER.findall(FIXTURE_SQL[name]):
        if ref not in seen:
            seen.append(ref)
    return seen


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Lineage inputs keyed by execution: written bucketed on that key so the
# joins and aggregates of a lineage job read co-located buckets.
BUCKETED = ("executions", "plan_nodes", "plan_columns")
# A base row becomes about one plan node and two columns, and a lineage step sorts
# a bucket's rows of several tables in one task: some 500 MB, so that the tasks of
# an executor, about 900 MB each, run side by side without spilling.
BASE_ROWS_PER_BUCKET = 250_000
# The base tables' column that becomes the execution's number.
EXECUTION_OF = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
# Tables written once per (application, folder) and reused by later queries.
_WRITTEN: dict[tuple[str, str, str], str] = {}


class Fixtures:
    """Fixture DataFrames for one scale-factor folder.

    Each table is a Spark plan over the parquet files (column pruning and
    filter pushdown reach the scans). With ``materialize`` the lineage inputs
    are written once to the shared checkpoint folder as tables bucketed by
    ``execution_id`` and read back, as a deployment reads its plan tables;
    later queries in the same application reuse them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True, dealt: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        # Partitions by execution that the base tables are dealt to (None: as they are read).
        self.dealt = dealt
        self._frames: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        key = f"base:{name}"
        if key not in self._frames:
            frame = read_base(self.spark, self.sf_dir, name)
            if self.dealt and name in EXECUTION_OF:
                frame = frame.repartition(self.dealt, EXECUTION_OF[name])
            self._frames[key] = frame
        return self._frames[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames and self.materialize and name in (*BUCKETED, "runs"):
            self._frames[name] = self._written(name)
        if name not in self._frames:
            if name == "runs":
                # Numbering within (app, run) is done skew-safe; same result as
                # the window in FIXTURE_SQL["runs"].
                self._frames[name] = self._runs_from_written()
                return self._frames[name]
            refs = {}
            for ref in dependencies(name):
                if ref.startswith("fx_"):
                    refs[ref] = self[ref[3:]]
                else:
                    refs[ref] = self.base(ref)
            text = FIXTURE_SQL[name].replace(ORDINALS, SPARK_ORDINALS).replace(*SPARK_HINTS.get(name, ("", "")), 1)
            self._frames[name] = self.spark.sql(text, **refs)
        return self._frames[name]

    @property
    def buckets(self) -> int:
        """Bucket count shared by every execution-keyed table of this data
        set, sized from the base tables' row counts (parquet answers them
        from file footers)."""
        from tracery.session import bucket_count

        key = (self.spark.sparkContext.applicationId, self.sf_dir, "buckets")
        if key not in _WRITTEN:
            rows = sum(self.base(base).count() for base in ("orders", "lineitem"))
            _WRITTEN[key] = bucket_count(self.spark, rows, BASE_ROWS_PER_BUCKET)
        return _WRITTEN[key]

    def derived(self, name: str) -> DataFrame:
        """The fixture as a plan over the base tables (never materialized), dealt
        like the buckets: each task numbers, makes and writes one bucket's rows."""
        return Fixtures(self.spark, self.sf_dir, materialize=False, dealt=self.buckets if name in BUCKETED else None)[name]

    def _written(self, name: str) -> DataFrame:
        from tracery.session import scratch_path

        app = self.spark.sparkContext.applicationId
        key = (app, self.sf_dir, name)
        table = _WRITTEN.get(key)
        if table is None or not self.spark.catalog.tableExists(table):
            table = f"tracery_{name}_{uuid.uuid4().hex}"
            frame = self.derived(name) if name != "runs" else self._runs_from_written()
            writer = frame.write.mode("overwrite").format("parquet").option("path", scratch_path(self.spark, name))
            if name in BUCKETED:
                writer = writer.bucketBy(self.buckets, "execution_id")
            writer.saveAsTable(table)
            _WRITTEN[key] = table
        return self.spark.table(table)

    def event_log(self, kind: str = "captured") -> str:
        """Event-log folder written from the fixture executions and plans
        (once per application and folder): ``captured`` with lineage metadata,
        ``physical`` as Spark logs plans itself."""
        from tracery.session import drop_written, scratch_path
        from tracery.sources import fixture_logs as L

        key = (self.spark.sparkContext.applicationId, self.sf_dir, f"eventlog-{kind}")
        root = _WRITTEN.get(key)
        if root is None:
            encode = L.encode_event_log if kind == "captured" else L.encode_physical_log
            steps: list = []
            lines = encode(self.executions, self.plan_nodes, self.buckets, steps)
            root = L.write_event_log(lines, scratch_path(self.spark, f"eventlog-{kind}"))
            drop_written(steps)
            _WRITTEN[key] = root
        return root

    def _runs_from_written(self) -> DataFrame:
        from tracery.operators.catalog import number_runs

        return number_runs(self["executions"])

    @property
    def executions(self) -> DataFrame:
        return self["executions"]

    @property
    def plan_nodes(self) -> DataFrame:
        return self["plan_nodes"]

    @property
    def plan_columns(self) -> DataFrame:
        return self["plan_columns"]


def duckdb_ctes(names: list[str]) -> str:
    """``WITH`` clause defining ``fx_<name>`` for the given fixtures (and what
    they depend on) over the pre-registered DuckDB views."""
    order: list[str] = []

    def visit(name: str) -> None:
        for ref in dependencies(name):
            if ref.startswith("fx_"):
                visit(ref[3:])
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in order:
        text = _PLACEHOLDER.sub(lambda m: m.group(1), FIXTURE_SQL[name].replace(ORDINALS, DUCKDB_ORDINALS)).strip()
        parts.append(f"fx_{name} as (\n{text}\n)")
    return "with " + ",\n".join(parts)
