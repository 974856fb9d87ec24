"""Composition of the lineage job: inputs -> gates -> walks -> records.

``LineagePlan`` holds one set of input tables (``executions``,
``plan_nodes``, ``plan_columns``) and builds each derived DataFrame once,
lazily. All frames are keyed by ``execution_id``; Spark plans one exchange
per input side and reuses it across the joins and aggregates that follow.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.functions import rules as R
from tracery.operators import catalog as C
from tracery.operators import extract as X
from tracery.operators import gates as G
from tracery.operators import records as Rec
from tracery.session import write_table


class LineagePlan:
    def __init__(self, executions: DataFrame, plan_nodes: DataFrame, plan_columns: DataFrame,
                 listener: tuple[str, ...] = ("app_name",), dev_markers: tuple[str, ...] = R.DEV_MARKERS,
                 checkpoint: bool = True, seen_listeners: DataFrame | None = None,
                 core: "LineagePlan | None" = None, buckets: int | None = None, empty_schemas: bool = True):
        self.executions = executions
        # Whether a file dataset without known columns gets a schema record.
        self.empty_schemas = empty_schemas
        # Bucket count of the execution-keyed inputs, so written steps stay
        # co-located with them (None: the session's shuffle partitions).
        self.buckets = buckets
        # Another plan over the same executions and plans: relation items,
        # failures, input/output lists and file-dataset schemas do not depend
        # on the job number or the listener, so they are reused from it.
        self.shared_core = core
        # Listeners that already emitted (streaming state): no first event again.
        self.seen_listeners = seen_listeners
        self.plan_nodes = X.with_paths(plan_nodes)
        self.plan_columns = plan_columns
        self.listener = listener
        self.dev_markers = dev_markers
        self.checkpoint = checkpoint

    # -- gates ---------------------------------------------------------------
    @cached_property
    def context(self) -> DataFrame:
        return G.execution_context(self.executions, self.plan_nodes, self.dev_markers)

    @cached_property
    def tracked(self) -> DataFrame:
        return G.tracked_context(self.context)

    # -- walks ---------------------------------------------------------------
    @cached_property
    def direct_visits(self) -> DataFrame:
        return X.direct_visits(self.tracked, self.plan_nodes)

    @cached_property
    def cached_leaves(self) -> DataFrame:
        return X.cached_leaves(self.direct_visits, self.plan_nodes, self.checkpoint, buckets=self.buckets,
                               written=self.written)

    @cached_property
    def items(self) -> DataFrame:
        if self.shared_core is not None:
            return self.shared_core.items
        items = X.relation_items(self.direct_visits.unionByName(self.cached_leaves))
        return self._cut(items, "items")

    def _cut(self, frame: DataFrame, name: str) -> DataFrame:
        """Materialize a step reused by many later ones: written once to the
        shared checkpoint folder, bucketed by execution, then read back."""
        if not self.checkpoint:
            return frame
        table = write_table(frame, name, bucket_by=G.KEY, buckets=self.buckets)
        self.written.append(table)
        return table

    @property
    def written(self) -> list:
        if "_written" not in self.__dict__:
            self.__dict__["_written"] = []
        return self.__dict__["_written"]

    def still_written(self) -> bool:
        """True while every table this plan (and a shared core) wrote can
        still be read."""
        if self.shared_core is not None and not self.shared_core.still_written():
            return False
        try:
            for frame in self.written:
                # A file that is gone or unreadable fails here, not in a query.
                frame.select(F.lit(1)).head(1)
        except Exception:  # noqa: BLE001 - a dropped table or removed folder
            return False
        return True

    def core(self) -> "LineagePlan":
        """Run the extraction core now (relation items and survivors)."""
        _ = self.items, self.alive
        return self

    @cached_property
    def outputs(self) -> DataFrame:
        return X.sink_outputs(self.tracked)

    # -- failure rule ----------------------------------------------------------
    @cached_property
    def failed(self) -> DataFrame:
        if self.shared_core is not None:
            return self.shared_core.failed
        sink = self.outputs.filter(F.col("fail_reason").isNotNull()).unionByName(
            X.sink_column_failures(self.outputs, self.plan_columns), allowMissingColumns=True)
        items = self.items.filter(F.col("fail_reason").isNotNull())
        return G.first_failures(self.tracked, sink, items)

    @cached_property
    def alive(self) -> DataFrame:
        return self._cut(Rec.survivors(self.tracked, self.failed), "alive")

    # -- lineage ---------------------------------------------------------------
    @cached_property
    def inputs(self) -> DataFrame:
        if self.shared_core is not None:
            return self.shared_core.inputs
        return Rec.surviving(self.items.filter(F.col("urn").isNotNull()), self.alive)

    @cached_property
    def alive_outputs(self) -> DataFrame:
        if self.shared_core is not None:
            return self.shared_core.alive_outputs
        return Rec.surviving(self.outputs.filter(F.col("urn").isNotNull()), self.alive)

    @cached_property
    def job_io(self) -> DataFrame:
        if self.shared_core is not None:
            # Same ordered lists; only the job number (URN) differs.
            return Rec.renumber_job_io(self.shared_core.job_io, self.alive)
        return Rec.job_io(self.alive, self.inputs, self.alive_outputs)

    @cached_property
    def job_info(self) -> DataFrame:
        return Rec.job_info(self.alive)

    # -- schemas ---------------------------------------------------------------
    @cached_property
    def column_types(self) -> DataFrame:
        return Rec.input_column_types(self.items, self.alive, self.plan_columns)

    @cached_property
    def file_datasets(self) -> DataFrame:
        return Rec.file_datasets(self.items, self.outputs, self.alive, self.buckets)

    @cached_property
    def file_dataset_columns(self) -> DataFrame:
        return Rec.file_dataset_columns(self.file_datasets, self.plan_columns)

    @cached_property
    def schema_fields(self) -> DataFrame:
        return Rec.schema_fields(self.file_dataset_columns, self.column_types)

    @cached_property
    def schema_metadata(self) -> DataFrame:
        if self.shared_core is not None:
            return self.shared_core.schema_metadata
        # Used by the dataset records of every run: written once.
        return self._cut(Rec.schema_metadata(self.file_datasets, self.schema_fields), "schema_metadata")

    # -- emission --------------------------------------------------------------
    @cached_property
    def first_events(self) -> DataFrame:
        firsts = Rec.first_events(self.alive, self.listener)
        if self.seen_listeners is not None:
            firsts = firsts.join(self.seen_listeners.select(*self.listener), list(self.listener), "left_anti")
        return firsts

    @cached_property
    def aspects(self) -> DataFrame:
        return self.records()

    def records(self, carry: tuple[str, ...] = ()) -> DataFrame:
        """``aspects`` with further columns of their executions."""
        every = Rec.aspects(self.alive, self.schema_metadata, self.job_io, self.job_info, self.first_events, carry)
        if self.empty_schemas:
            return every
        return every.filter("not (aspect_name = 'schemaMetadata' and aspect like '%\"fields\":[]%')")

    @cached_property
    def catalog(self) -> DataFrame:
        """E7 applied to everything emitted (no reset)."""
        return C.latest_per_key(self.aspects)


class TwoRunCatalog:
    """Two runs of every application against one catalog.

    Job numbers restart per run (``run_execution_id``), so a re-run writes the
    same job URNs again; at each run's first event all members of the flow are
    deleted before the run's own records are written.
    """

    def __init__(self, executions: DataFrame, plan_nodes: DataFrame, plan_columns: DataFrame,
                 runs: DataFrame, relationships: DataFrame,
                 checkpoint: bool = True, core: LineagePlan | None = None, buckets: int | None = None):
        run_cols = runs.select(G.KEY, "run_no", F.col("run_execution_id").alias("job_number"))
        self.runs = run_cols
        self.relationships = relationships
        self.plan = LineagePlan(executions.join(run_cols, G.KEY, "inner"), plan_nodes, plan_columns,
                                listener=("app_name", "run_no"), checkpoint=checkpoint, core=core,
                                buckets=buckets)

    @property
    def writes(self) -> DataFrame:
        """All records both runs emit, written once, as they come: the upserts
        that follow combine a hot URN's records before their shuffle, whereas a
        table bucketed by URN would hold them in one bucket."""
        shared = self.plan.__dict__
        if "_run_writes" not in shared:
            writes = self.plan.records(carry=("run_no",))
            if self.plan.checkpoint:
                writes = write_table(writes, "run_writes")
                self.plan.written.append(writes)
            shared["_run_writes"] = writes
        return shared["_run_writes"]

    @cached_property
    def upsert_all(self) -> DataFrame:
        return C.latest_per_key(self.writes)

    @cached_property
    def members(self) -> DataFrame:
        return C.flow_members(self.relationships)

    @cached_property
    def reset(self) -> DataFrame:
        firsts = self.plan.first_events.filter(F.col("run_no") == 2)
        return C.pipeline_reset(firsts, self.plan.alive, self.members)

    @cached_property
    def after_reset(self) -> DataFrame:
        run1 = C.latest_per_key(self.writes.filter(F.col("run_no") == 1))
        return C.delete_entities(run1, self.reset)

    @cached_property
    def current(self) -> DataFrame:
        run2 = self.writes.filter(F.col("run_no") == 2).drop("run_no")
        cols = list(self.after_reset.columns)
        return C.latest_per_key(self.after_reset.unionByName(run2.select(*cols)))
