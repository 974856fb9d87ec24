"""DuckDB oracle SQL for every registered query.

the fixtures are inlined as CTEs over the driver's views, then each step is
a plain SQL CTE. Windows and a recursive CTE are fine here; the oracle only
runs on the small correctness scale.
"""

from __future__ import annotations

import re

from tracery.sources.fixtures import FIXTURE_SQL, duckdb_ctes


def _q(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


# Fixed values, written out here so that a wrong constant in the DataFrame code shows.
TRACKED = _q((
    "SaveIntoDataSourceCommand", "CreateDataSourceTableAsSelectCommand", "CreateHiveTableAsSelectCommand",
    "InsertIntoHiveTable", "HiveTableRelation", "LogicalRelation", "InsertIntoHadoopFsRelationCommand",
    "InMemoryRelation"))
SINKS = _q(("InsertIntoHadoopFsRelationCommand", "SaveIntoDataSourceCommand", "InsertIntoHiveTable",
            "CreateHiveTableAsSelectCommand"))
RELS = _q(("HiveTableRelation", "LogicalRelation", "InMemoryRelation"))
TYPE_MAP = (
    ("void", "NullType", "Null"), ("date", "DateType", "Date"), ("interval", "DateType", "Calendar"),
    ("timestamp", "TimeType", "Timestamp"), ("tinyint", "BytesType", "Byte"), ("binary", "BytesType", "Binary"),
    ("boolean", "BooleanType", "Boolean"), ("int", "NumberType", "Integer"), ("bigint", "NumberType", "Long"),
    ("double", "NumberType", "Double"), ("float", "NumberType", "Float"), ("smallint", "NumberType", "Short"),
    ("string", "StringType", "String"))


def _jdbc_platform(url: str) -> str:
    parts = f"string_split(regexp_replace({url}, ':+$', ''), ':')"
    return (f"(case when len({parts}) >= 2 then "
            f"(case when list_extract({parts}, 2) = 'sqlserver' then 'mssql' else list_extract({parts}, 2) end) end)")


def _hive_name(path: str) -> str:
    segs = f"string_split(regexp_replace({path}, '/+$', ''), '/')"
    return (f"(case when len({segs}) >= 2 then "
            f"replace(list_extract({segs}, -2), 'db', '') || list_extract({segs}, -1) end)")


def _qualified(db: str, tbl: str) -> str:
    return f"concat_ws('.', nullif({db}, ''), {tbl})"


def _urn(platform: str, name: str, env: str) -> str:
    return f"('urn:li:dataset:(urn:li:dataPlatform:' || {platform} || ',' || {name} || ',' || {env} || ')')"


def _flow(app: str = "app_name", master: str = "master") -> str:
    return f"('urn:li:dataFlow:(spark,' || {app} || ',' || {master} || ')')"


def _job(flow: str, num: str) -> str:
    return f"('urn:li:dataJob:(' || {flow} || ',ExecutionId_' || cast({num} as varchar) || ')')"


def _env(fs: str) -> str:
    return f"(case when {fs} is null then null when contains({fs}, 'stag') then 'DEV' else 'PROD' end)"


NODE_ATTRS = "relation_class, catalog_db, catalog_table, paths, jdbc_url, jdbc_table"


def _lineage_ctes(p: str, executions: str) -> dict[str, str]:
    """The lineage chain with CTE names prefixed ``p`` over an executions CTE
    that has ``job_number``."""
    n = "fx_plan_nodes"
    c = "fx_plan_columns"
    return {
        f"{p}ctx": f"""
select e.*, r.node_class as root_class, r.catalog_db as root_catalog_db, r.catalog_table as root_catalog_table,
       r.path as root_path, r.jdbc_url as root_jdbc_url, r.jdbc_table as root_jdbc_table, {_env('e.default_fs')} as env
from {executions} e join {n} r on r.execution_id = e.execution_id and r.edge_kind = 'root'
where e.app_name is not null and e.master is not null and e.started_at is not null""",
        f"{p}tracked": f"select * from {p}ctx where root_class in ({TRACKED})",
        f"{p}visits": f"""
select n.execution_id, 0 as pass, n.node_id, -1 as leaf_id, n.node_class, {', '.join('n.' + a.strip() for a in NODE_ATTRS.split(','))},
       t.env, t.input_override, n.node_id as col_node
from {n} n join {p}tracked t on t.execution_id = n.execution_id
where t.root_class in ({SINKS}) and n.edge_kind in ('child', 'inner_query') and n.node_class = 'LogicalRelation'
union all
select n.execution_id, 1 as pass, n.node_id, -1 as leaf_id, n.node_class, {', '.join('n.' + a.strip() for a in NODE_ATTRS.split(','))},
       t.env, t.input_override, n.node_id as col_node
from {n} n join {p}tracked t on t.execution_id = n.execution_id
where n.edge_kind in ('root', 'child') and n.node_class in ({RELS})""",
        f"{p}reach": f"""
select c.execution_id, v.node_id as owner, c.node_id, c.node_class, {', '.join('c.' + a.strip() for a in NODE_ATTRS.split(','))},
       v.env, v.input_override
from {p}visits v join {n} c on c.execution_id = v.execution_id and c.parent_id = v.node_id and c.edge_kind = 'cached'
where v.pass = 1 and v.node_class = 'InMemoryRelation'
union all
select c.execution_id, r.owner, c.node_id, c.node_class, {', '.join('c.' + a.strip() for a in NODE_ATTRS.split(','))},
       r.env, r.input_override
from {p}reach r join {n} c on c.execution_id = r.execution_id and c.parent_id = r.node_id and c.edge_kind = 'cached'""",
        f"{p}leaves": f"""
select r.execution_id, 1 as pass, r.owner as node_id, r.node_id as leaf_id, r.node_class, {NODE_ATTRS},
       r.env, r.input_override, r.node_id as col_node
from {p}reach r
where not exists (select 1 from {n} k where k.execution_id = r.execution_id and k.parent_id = r.node_id
                  and k.edge_kind = 'cached')""",
        f"{p}items0": f"""
select v.*, case when s.sub = 1 and v.relation_class = 'HadoopFsRelation' then v.paths[s.k + 1] end as path,
       s.sub + s.k as sub,
       s.sub = 1 and v.relation_class = 'HadoopFsRelation' as is_file,
       s.sub = 1 and coalesce(contains(v.relation_class, 'JDBCRelation'), false) as is_jdbc,
       {_hive_name("(case when s.sub = 1 then v.paths[s.k + 1] end)")} as hive_name,
       {_jdbc_platform('v.jdbc_url')} as jplat
from (select * from {p}visits union all select * from {p}leaves) v, (values (0, 0), (1, 0), (1, 1)) s(sub, k)
where (s.k = 0 or (v.relation_class = 'HadoopFsRelation' and len(v.paths) > s.k)) and ((s.sub = 0 and ((v.node_class = 'LogicalRelation' and v.catalog_table is not null)
                      or v.node_class = 'HiveTableRelation' or contains(v.node_class, 'HiveTableScanExec')))
   or (s.sub = 1 and v.node_class in ('LogicalRelation', 'FileSourceScanExec', 'RowDataSourceScanExec')))""",
        f"{p}items1": f"""
select *,
       is_file and path is not null and contains(path, 'hive') as hive_path,
       is_file and path is not null and not contains(path, 'hive') as file_path
from {p}items0""",
        f"{p}items2": f"""
select execution_id, pass, node_id, leaf_id, sub, node_class, env, col_node,
       case when sub = 0 then 'hive' when file_path then 'hdfs' when hive_path then 'hive' when is_jdbc then jplat end as platform,
       case when sub = 0 then {_qualified('catalog_db', 'catalog_table')}
            when file_path then coalesce(nullif(input_override, ''), path)
            when hive_path then hive_name when is_jdbc then jdbc_table end as name,
       case when hive_path and hive_name is null then 'hive path with fewer than two segments'
            when is_jdbc and jdbc_table is null then 'jdbc read without dbtable'
            when is_jdbc and jdbc_url is not null and jplat is null then 'jdbc url without platform' end as fail_reason,
       coalesce(sub = 0 or is_file or is_jdbc, false) as records_schema,
       coalesce(file_path, false) as file_record
from {p}items1""",
        f"{p}items": f"""
select *, case when platform is not null and name is not null and fail_reason is null
               then {_urn('platform', 'name', 'env')} end as urn
from {p}items2""",
        f"{p}sinks0": f"""
select execution_id, -1 as pass, 0 as node_id, -1 as leaf_id, 0 as sub, env, 0 as col_node,
       root_class = 'InsertIntoHadoopFsRelationCommand' and root_catalog_table is not null as file_catalog,
       root_class = 'InsertIntoHadoopFsRelationCommand' and root_catalog_table is null as file_path,
       root_class = 'SaveIntoDataSourceCommand' as jdbc,
       root_class in ('InsertIntoHiveTable', 'CreateHiveTableAsSelectCommand') as hive_sink,
       {_jdbc_platform('root_jdbc_url')} as jplat,
       root_catalog_db, root_catalog_table, root_path, root_jdbc_url, root_jdbc_table, output_override
from {p}tracked where root_class in ({SINKS})""",
        f"{p}sinks1": f"""
select execution_id, pass, node_id, leaf_id, sub, env, col_node, file_path as file_record,
       case when hive_sink or file_catalog then 'hive' when file_path then 'hdfs' when jdbc then jplat end as platform,
       case when hive_sink or file_catalog then {_qualified('root_catalog_db', 'root_catalog_table')}
            when file_path then coalesce(nullif(output_override, ''), root_path)
            when jdbc then root_jdbc_table end as name,
       case when jdbc and root_jdbc_url is null then 'jdbc save without url'
            when jdbc and root_jdbc_table is null then 'jdbc save without dbtable'
            when jdbc and jplat is null then 'jdbc url without platform' end as fail_reason
from {p}sinks0""",
        f"{p}sinks": f"""
select *, case when platform is not null and name is not null and fail_reason is null
               then {_urn('platform', 'name', 'env')} end as urn
from {p}sinks1""",
        f"{p}fail_all": f"""
select execution_id, -2 as pass, 0 as node_id, -1 as leaf_id, 0 as sub, 'missing default filesystem' as fail_reason
from {p}tracked where default_fs is null
union all
select execution_id, pass, node_id, leaf_id, sub, fail_reason from {p}sinks where fail_reason is not null
union all
select s.execution_id, s.pass, s.node_id, s.leaf_id, s.sub, 'output column without expression id'
from {p}sinks s where s.file_record and exists (
  select 1 from {c} pc where pc.execution_id = s.execution_id and pc.node_id = 0 and strpos(pc.column_text, '#') = 0)
union all
select execution_id, pass, node_id, leaf_id, sub, fail_reason from {p}items where fail_reason is not null""",
        f"{p}failed": f"""
select execution_id, fail_reason from (
  select *, row_number() over (partition by execution_id order by pass, node_id, leaf_id, sub) as rn
  from {p}fail_all) x where rn = 1""",
        f"{p}alive": f"""
select * from {p}tracked t where not exists (select 1 from {p}failed f where f.execution_id = t.execution_id)""",
        f"{p}inputs": f"""
select i.* from {p}items i where i.urn is not null
  and exists (select 1 from {p}alive a where a.execution_id = i.execution_id)""",
        f"{p}outputs": f"""
select s.* from {p}sinks s where s.urn is not null
  and exists (select 1 from {p}alive a where a.execution_id = s.execution_id)""",
        f"{p}job_io": f"""
select a.execution_id, {_job(_flow('a.app_name', 'a.master'), 'a.job_number')} as job_urn,
       {_flow('a.app_name', 'a.master')} as flow_urn,
       coalesce(i.input_urns, '') as input_urns, coalesce(o.output_urns, '') as output_urns,
       cast(coalesce(i.n, 0) as integer) as n_inputs, cast(coalesce(o.n, 0) as integer) as n_outputs,
       coalesce(i.lst, []::varchar[]) as input_list, coalesce(o.lst, []::varchar[]) as output_list
from {p}alive a
left join (select execution_id, string_agg(urn, '|' order by pass, node_id, leaf_id, sub) as input_urns,
                  list(urn order by pass, node_id, leaf_id, sub) as lst, count(*) as n
           from {p}inputs group by execution_id) i on i.execution_id = a.execution_id
left join (select execution_id, string_agg(urn, '|' order by pass, node_id, leaf_id, sub) as output_urns,
                  list(urn order by pass, node_id, leaf_id, sub) as lst, count(*) as n
           from {p}outputs group by execution_id) o on o.execution_id = a.execution_id""",
        f"{p}job_info": f"""
select execution_id, {_job(_flow(), 'job_number')} as job_urn, description as name, 'sparkJob' as type,
       strftime(started_at, '%a %b %d %H:%M:%S UTC %Y') as started_at, cast(job_number as varchar) as app_id, app_name
from {p}alive""",
        f"{p}col_types": f"""
select execution_id, column_name, data_type from (
  select r.execution_id, pc.column_text as column_name, pc.data_type,
         row_number() over (partition by r.execution_id, pc.column_text
                            order by r.pass desc, r.node_id desc, r.leaf_id desc, r.sub desc, pc.ordinal desc) as rn
  from {p}items r join {c} pc on pc.execution_id = r.execution_id and pc.node_id = r.col_node
  where r.records_schema and exists (select 1 from {p}alive a where a.execution_id = r.execution_id)) x
where rn = 1""",
        f"{p}file_recs": f"""
select execution_id, env, name as dataset, pass, node_id, leaf_id, sub, col_node, true as is_output
from {p}sinks where file_record and name is not null
union all
select execution_id, env, name as dataset, pass, node_id, leaf_id, sub, col_node, false as is_output
from {p}items where file_record""",
        f"{p}file_ds": f"""
select execution_id, dataset, env, col_node, is_output from (
  select f.*, row_number() over (partition by execution_id, dataset
                                 order by pass desc, node_id desc, leaf_id desc, sub desc) as rn
  from {p}file_recs f where exists (select 1 from {p}alive a where a.execution_id = f.execution_id)) x
where rn = 1""",
        f"{p}file_cols": f"""
select d.execution_id, d.dataset, d.env, pc.ordinal,
       case when d.is_output then split_part(pc.column_text, '#', 1) else pc.column_text end as column_name
from {p}file_ds d join {c} pc on pc.execution_id = d.execution_id and pc.node_id = d.col_node""",
        f"{p}fields": f"""
select f.execution_id, f.dataset, f.env, f.ordinal, f.column_name as field_path,
       coalesce(m.ft, 'NullType') as field_type, coalesce(m.nt, 'New Column') as native_type
from {p}file_cols f
left join {p}col_types t on t.execution_id = f.execution_id and t.column_name = f.column_name
left join (values {', '.join(f"('{a}', '{b}', '{c2}')" for a, b, c2 in TYPE_MAP)}) m(dt, ft, nt) on m.dt = t.data_type""",
        f"{p}schema_meta": f"""
select d.execution_id, d.dataset, d.env, {_urn("'hdfs'", 'd.dataset', 'd.env')} as urn,
       d.dataset || '_schema' as schema_name, 1 as version, '' as hash, 'urn:li:dataPlatform:hdfs' as platform,
       coalesce(g.fields, []) as fields, cast(coalesce(len(g.fields), 0) as integer) as n_fields
from {p}file_ds d
left join (select execution_id, dataset,
                  list(struct_pack(fieldPath := field_path, nativeDataType := native_type, type := field_type)
                       order by ordinal) as fields
           from {p}fields group by execution_id, dataset) g
  on g.execution_id = d.execution_id and g.dataset = d.dataset""",
        f"{p}aspects": f"""
select x.execution_id, a.started_at, x.emit_seq, regexp_extract(x.urn, '^urn:li:(\\w+):', 1) as entity_type,
       x.urn, x.aspect_name, x.aspect
from (
  select execution_id, 1 as emit_seq, urn, 'datasetProperties' as aspect_name,
         to_json(struct_pack(name := dataset)) as aspect from {p}schema_meta
  union all
  select execution_id, 2, urn, 'schemaMetadata',
         to_json(struct_pack(schemaName := schema_name, platform := platform, version := version, hash := hash,
                             fields := fields)) from {p}schema_meta
  union all
  select execution_id, 3, {_flow()}, 'dataFlowInfo', to_json(struct_pack(name := app_name))
  from {p}alive where execution_id in (select execution_id from {p}firsts)
  union all
  select execution_id, 4, job_urn, 'dataJobInfo',
         to_json(struct_pack(name := name, type := type,
                             customProperties := struct_pack(startedAt := started_at, appId := app_id, appName := app_name)))
  from {p}job_info
  union all
  select execution_id, 5, job_urn, 'dataJobInputOutput',
         to_json(struct_pack(inputDatasets := input_list, outputDatasets := output_list)) from {p}job_io
) x join {p}alive a on a.execution_id = x.execution_id""",
    }


def _firsts(p: str, partition: str) -> dict[str, str]:
    return {
        f"{p}firsts": f"""
select {partition}, execution_id from (
  select {partition}, execution_id,
         row_number() over (partition by {partition} order by started_at, execution_id) as rn
  from {p}alive) x where rn = 1""",
    }


def _latest(src: str) -> str:
    return f"""
select urn, aspect_name, started_at, execution_id, emit_seq, entity_type, aspect from (
  select *, row_number() over (partition by urn, aspect_name
                               order by started_at desc, execution_id desc, emit_seq desc) as rn
  from {src}) x where rn = 1"""


def _catalog_ctes() -> dict[str, str]:
    return {
        "c_members": """
select entity_urn as flow_urn, related_urn as member_urn
from fx_relationships where rel_type = 'IsPartOf' and direction = 'INCOMING'""",
        "c_reset": f"""
select a.app_name, m.member_urn as deleted_urn
from r_alive a join r_firsts f on f.execution_id = a.execution_id
join c_members m on m.flow_urn = {_flow('a.app_name', 'a.master')}
where f.run_no = 2""",
        "c_after_reset": """
select * from r_run1 c where not exists (select 1 from c_reset d where d.deleted_urn = c.urn)""",
        "c_current": _latest(
            "(select * from c_after_reset union all "
            "select urn, aspect_name, started_at, execution_id, emit_seq, entity_type, aspect from r_writes where run_no = 2)"),
    }


def _all_ctes() -> dict[str, str]:
    ctes: dict[str, str] = {}
    ctes["o_exec"] = "select *, execution_id as job_number from fx_executions"
    ctes.update(_lineage_ctes("o_", "o_exec"))
    ctes.update(_firsts("o_", "app_name"))
    # What a plain physical log tells of the plans: JDBC reads without URL, saves by driver.
    ctes["p_nodes"] = """
select execution_id, node_id, parent_id, edge_kind, node_class, relation_class,
       case when node_class in ('CreateHiveTableAsSelectCommand', 'CreateDataSourceTableAsSelectCommand')
            then coalesce(catalog_db, 'default') else catalog_db end as catalog_db,
       case when node_class = 'CreateDataSourceTableAsSelectCommand' then coalesce(catalog_table, 't') else catalog_table end as catalog_table,
       path, paths,
       case when node_class <> 'SaveIntoDataSourceCommand' then null
            when contains(jdbc_url, 'sqlserver') then 'jdbc:sqlserver:x' when jdbc_url is not null then 'jdbc:mysql:x' end as jdbc_url,
       case when (relation_class = 'JDBCRelation' or node_class = 'RowDataSourceScanExec') then coalesce(jdbc_table, '(select 1) x')
            else jdbc_table end as jdbc_table
from fx_plan_nodes"""
    ctes.update({k: v.replace("fx_plan_nodes", "p_nodes").replace("fx_plan_columns", "(select * from fx_plan_columns where node_id < 0)")
                 for k, v in {**_lineage_ctes("p_", "o_exec"), **_firsts("p_", "app_name")}.items()})
    ctes["r_exec"] = ("select e.*, r.run_no, r.run_execution_id as job_number "
                      "from fx_executions e join fx_runs r on r.execution_id = e.execution_id")
    ctes.update(_lineage_ctes("r_", "r_exec"))
    ctes.update(_firsts("r_", "app_name, run_no"))
    ctes["r_writes"] = ("select w.*, r.run_no from r_aspects w "
                        "join fx_runs r on r.execution_id = w.execution_id")
    ctes["r_run1"] = _latest("(select * from r_writes where run_no = 1)")
    ctes["r_upsert"] = _latest("r_writes")
    ctes.update(_catalog_ctes())
    return ctes


CTES = _all_ctes()

FINAL: dict[str, str] = {
    "tracked_executions": "select execution_id, root_class as node_class from o_tracked",
    "failed_executions": "select execution_id, fail_reason from o_failed",
    "executions_without_plan": """
select execution_id, 'no query execution' as reason from fx_executions e
where not exists (select 1 from fx_plan_nodes n where n.execution_id = e.execution_id and n.edge_kind = 'root')""",
    "dropped_executions": """
select execution_id, reason from (
  select execution_id, case when app_name is null or master is null then 'context is null'
                            when started_at is null then 'start event is null' end as reason
  from fx_executions) x where reason is not null""",
    "tracked_nodes": f"select execution_id, node_id, node_class from fx_plan_nodes where node_class in ({TRACKED})",
    "lineage_outputs": "select execution_id, platform, name, env, urn from o_outputs",
    "lineage_inputs": ("select execution_id, pass, node_id, leaf_id, sub, platform, name, env, urn "
                       "from o_inputs where leaf_id = -1"),
    "cached_inputs": ("select execution_id, pass, node_id, leaf_id, sub, platform, name, env, urn "
                      "from o_inputs where leaf_id >= 0"),
    "job_io": ("select execution_id, job_urn, flow_urn, input_urns, output_urns, n_inputs, n_outputs "
               "from o_job_io"),
    "job_info": "select execution_id, job_urn, name, type, started_at, app_id, app_name from o_job_info",
    "input_column_types": "select execution_id, column_name, data_type from o_col_types",
    "file_dataset_columns": "select execution_id, dataset, ordinal, column_name from o_file_cols",
    "schema_fields": ("select execution_id, dataset, ordinal, field_path, field_type, native_type "
                      "from o_fields"),
    "schema_metadata": ("select execution_id, dataset, urn, schema_name, version, hash, platform, n_fields "
                        "from o_schema_meta"),
    "dataset_properties": "select execution_id, urn, dataset as name from o_schema_meta",
    "first_events": "select app_name, execution_id from o_firsts",
    "flow_info": f"select {_flow()} as urn, app_name as name from o_alive where execution_id in (select execution_id from o_firsts)",
    "aspects": "select execution_id, emit_seq, entity_type, urn, aspect_name, aspect from o_aspects",
    "emit_summary": "select aspect_name, entity_type, count(*) as n from o_aspects group by aspect_name, entity_type",
    "job_urns": f"select execution_id, {_flow()} as flow_urn, {_job(_flow(), 'execution_id')} as job_urn from fx_executions",
    "environment": f"select execution_id, {_env('default_fs')} as env from fx_executions where default_fs is not null",
    "qualified_names": (f"select execution_id, node_id, {_qualified('catalog_db', 'catalog_table')} as qualified_name "
                        "from fx_plan_nodes where catalog_table is not null"),
    "jdbc_platform": (f"select execution_id, node_id, {_jdbc_platform('jdbc_url')} as platform "
                      "from fx_plan_nodes where jdbc_url is not null"),
    "hive_name_from_path": (f"select execution_id, node_id, path, {_hive_name('path')} as name "
                            "from fx_plan_nodes where contains(path, 'hive')"),
    "path_kind": ("select execution_id, node_id, path, case when contains(path, 'hive') then 'hive' else 'hdfs' end as kind "
                  "from fx_plan_nodes where path is not null"),
    "path_override": f"""
select n.execution_id, n.node_id, n.path,
       case when n.node_class in ({SINKS}) then coalesce(nullif(e.output_override, ''), n.path)
            else coalesce(nullif(e.input_override, ''), n.path) end as dataset
from fx_plan_nodes n join fx_executions e on e.execution_id = n.execution_id
where n.path is not null""",
    "output_column_names": ("select execution_id, ordinal, split_part(column_text, '#', 1) as column_name "
                            "from fx_plan_columns where node_id = 0"),
    "catalog_upsert": "select emit_seq, entity_type, urn, aspect_name, aspect from r_upsert",
    "catalog_current": "select emit_seq, entity_type, urn, aspect_name, aspect from c_current",
    "flow_members": "select flow_urn, member_urn from c_members",
    "pipeline_reset": "select app_name, deleted_urn from c_reset",
    "catalog_after_reset": "select urn, aspect_name from c_after_reset",
    "catalog_live": """
select urn, removed from (
  select urn, removed, row_number() over (partition by urn order by seq desc) as rn from fx_flow_status) x
where rn = 1""",
}
_APP_ID = "('local-' || substring(app_name, 5))"
FINAL["sql_executions"] = f"""
select execution_id, app_name, master, description, started_at, default_fs, input_override, output_override,
       {_APP_ID} as app_id from fx_executions"""
FINAL["app_starts"] = f"select {_APP_ID} as app_id, min(started_at) as time, 'spark' as user from fx_executions group by app_name"
FINAL["app_ends"] = f"select {_APP_ID} as app_id, max(started_at) as time from fx_executions group by app_name"
FINAL["session_settings"] = f"""
select app_id, key, value from (
  select {_APP_ID} as app_id, max(master) as master, app_name, max(default_fs) as fs,
         max(input_override) as i, max(output_override) as o
  from fx_executions group by app_name) a,
  lateral (select 'spark.master' as key, master as value
           union all select 'spark.app.name', app_name
           union all select 'fs.defaultFS', fs
           union all select 'spark.hdfs.ingestion.input.path', nullif(i, '')
           union all select 'spark.hdfs.ingestion.output.path', nullif(o, '')) kv
where value is not null"""
FINAL["event_plan_nodes"] = ("select execution_id, node_id, parent_id, edge_kind, node_class, relation_class, "
                             "catalog_db, catalog_table, path, jdbc_url, jdbc_table from fx_plan_nodes")
FINAL["event_job_io"] = FINAL["job_io"]

FINAL["physical_plan_nodes"] = f"""
select execution_id, edge_kind, node_class, relation_class, catalog_db, catalog_table, jdbc_table, array_to_string(paths, '|') as path_list
from p_nodes where node_class in ({TRACKED})"""
FINAL["physical_job_io"] = ("select execution_id, job_urn, flow_urn, input_urns, output_urns, n_inputs, n_outputs "
                            "from p_job_io")

# The streamed catalog must equal the batch upsert; the stream replays
# executions in time order, so its first events equal the batch ones.
FINAL["stream_catalog_upsert"] = FINAL["catalog_upsert"]
FINAL["stream_first_events"] = FINAL["first_events"]
# At a run's first event all jobs of its flow go: of run 1 only jobs of applications without a second run stay.
FINAL["stream_catalog_current"] = f"""
select u.emit_seq, u.entity_type, u.urn, u.aspect_name, u.aspect
from r_upsert u join fx_runs x on x.execution_id = u.execution_id
where u.entity_type <> 'dataJob' or x.run_no = 2
   or not exists (select 1 from r_alive a where a.run_no = 2
                  and contains(u.urn, '(' || {_flow('a.app_name', 'a.master')} || ',ExecutionId_'))"""
FINAL["stream_log_catalog"] = "select urn, aspect_name, aspect from p_aspects where entity_type = 'dataJob'"
FINAL["stream_emit_log"] = ("select a.aspect_name, 'success' as outcome, count(w.urn) as n "
                            "from (values ('datasetProperties'), ('schemaMetadata'), ('dataFlowInfo'), ('dataJobInfo'), "
                            "('dataJobInputOutput')) a(aspect_name) left join r_writes w on w.aspect_name = a.aspect_name group by all")

_WORD = re.compile(r"\b([a-z][a-z0-9_]*)\b")
_FIXTURES = tuple(f"fx_{name}" for name in FIXTURE_SQL)


def _deps(text: str, known) -> list[str]:
    out: list[str] = []
    for w in _WORD.findall(text):
        if w in known and w not in out:
            out.append(w)
    return out


def build(name: str) -> str:
    """Full DuckDB SQL for one query: fixture CTEs, needed steps, final select."""
    final = FINAL[name]
    order: list[str] = []

    def visit(cte: str, stack=()) -> None:
        if cte in order or cte in stack:
            return
        for dep in _deps(CTES[cte], CTES):
            if dep != cte:
                visit(dep, stack + (cte,))
        order.append(cte)

    for dep in _deps(final, CTES):
        visit(dep)
    text = final + " ".join(CTES[c] for c in order)
    fixtures = [f[3:] for f in _FIXTURES if re.search(rf"\b{f}\b", text)]
    head = duckdb_ctes(fixtures)
    body = ",\n".join(f"{c} as ({CTES[c]}\n)" for c in order)
    recursive = any(re.search(rf"\b{c}\b", CTES[c].split("union all", 1)[-1]) for c in order
                    if "union all" in CTES[c])
    sql = head + (",\n" + body if body else "") + "\n" + final
    if recursive:
        sql = "with recursive " + sql[len("with "):]
    return sql


def oracle_sql() -> dict[str, str]:
    return {name: build(name) for name in FINAL}
