"""Sessions kept up to date from new rows alone (clean mode).

Per entity the last session is carried: its enter row, its last row and the place of the last
row seen. Rows behind that place need nothing else: the carried session stands for all rows it
holds, and the run reads the new rows and one row per entity.

A late row lies before that place. Late rows without an enter mark can only move the end of the
session they fall into, for which its first and last row are enough; so the stored sessions of
the entity are read. A late enter row cuts a session in two, and where the first part ends is
known from the rows only: the stretch of its entity from the first session cut to the end of the
last one is read again from the stored rows, with their times as bounds of the scan. Sessions
that come out as they were are not written.

Every run is a batch under one commit record, which also keeps the positions in the source up
to which rows were taken. A run that dies leaves nothing that counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.operators import sessions as S
from studytrail.operators.slices import ROWS_PER_SLICE
from studytrail.runtime import drop_folder, shared_folder
from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.commits import Batch, CommitLog


def place(ct: str | Column = "ct", id_: str | Column = "id") -> Column:
    """The place of a row in its entity's order; null ids come first, as in a sort."""
    columns = [F.col(c) if isinstance(c, str) else c for c in (ct, id_)]
    return F.struct(columns[0].alias("ct"), columns[1].alias("id"))


def _within(where: Column) -> Column:
    """Whether a place lies in the stretch low .. upto, whose ends may be open."""
    return F.coalesce(where >= F.col("low"), F.lit(True)) & F.coalesce(where <= F.col("upto"), F.lit(True))


class SessionStore:
    """Rows, sessions and entities of one session job under one root folder."""

    def __init__(self, spark: SparkSession, root: str, spec: S.SessionSpec, rows_per_slice: int = ROWS_PER_SLICE):
        self.spark, self.root, self.spec, self.rows_per_slice = spark, root.rstrip("/"), spec, rows_per_slice
        # The peak belongs to the entity, not to its sessions; it is kept and joined there.
        self.plain = replace(spec, peak=None, peak_key=())
        self.commits = CommitLog(spark, self.root)
        self.rows, self.sessions, self.entities, self.closed = (
            BatchFolder(spark, f"{self.root}/{name}", self.commits) for name in ("rows", "sessions", "entities", "closed")
        )
        self.opening = [out for out, _ in spec.output]
        self.session = [*self.opening, "minct", "maxct", "last_id"]

    # -- what is stored

    def _schemas(self, rows: DataFrame) -> tuple[str, str, str]:
        """DDL of the three tables, from the log's types."""
        kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        log = ", ".join(f"`{c}` {kind[c]}" for c in self.spec.log_columns)
        opening = [f"`{out}` {kind[src]}" for out, src in self.spec.output]
        session = ", ".join([*opening, f"minct {kind['ct']}", f"maxct {kind['ct']}", f"last_id {kind['id']}"])
        key = ", ".join(f"`{c}` {kind[c]}" for c in self.spec.entity)
        nested = session.replace("` ", "`:").replace("minct ", "minct:").replace("maxct ", "maxct:").replace("last_id ", "last_id:")
        high = f"high struct<ct:{kind['ct']},id:{kind['id']}>"
        peak = f"peak {kind.get(self.spec.peak, 'double')}"
        return log, f"{session}, version bigint", f"{key}, {high}, {peak}, last struct<{nested}>, version bigint"

    def _closed_schema(self, rows: DataFrame) -> str:
        kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        opening = ", ".join(f"`{out}` {kind[src]}" for out, src in self.spec.output)
        peak = f", maxsp {kind[self.spec.peak]}" if self.spec.peak else ""
        return f"{opening}{peak}, minct {kind['ct']}, maxct {kind['ct']}, again boolean"

    def _newest_sessions(self, schema: str) -> DataFrame:
        """A session is known by its opening fields and start; its newest end counts."""
        rest = ["maxct", "last_id"]
        return self.sessions.read(schema).groupBy(*self.opening, "minct").agg(
            F.max_by(F.struct(*rest), "version").alias("r")
        ).select(*self.opening, "minct", *[f"r.{c}" for c in rest])

    def _newest_entities(self, schema: str) -> DataFrame:
        state = ["high", "peak", "last"]
        newest = self.entities.read(schema).groupBy(*self.spec.entity).agg(F.max_by(F.struct(*state), "version").alias("r"))
        return newest.select(*self.spec.entity, *[f"r.{c}" for c in state])

    def _of(self, rows: DataFrame, chosen: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows joined to a table by entity, null keys included; the table's keys get a prefix."""
        other = chosen.select(
            *[F.col(c).alias(f"__{c}") for c in self.spec.entity], *[c for c in chosen.columns if c not in self.spec.entity]
        )
        match = F.lit(True)
        for c in self.spec.entity:
            match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
        joined = rows.join(other, match, how)
        return joined.drop(*[f"__{c}" for c in self.spec.entity])

    def _log_shaped(self, sessions: DataFrame, schema) -> DataFrame:
        """The enter row and the last row of sessions, other columns null."""
        source = dict((src, out) for out, src in self.spec.output)
        kind = {f.name: f.dataType for f in schema.fields}
        at = lambda number: F.lit(number).cast(kind["at"])

        def column(c: str, first: bool) -> Column:
            if c == "at":
                return at(1 if first else 0)
            if c == "ct":
                return F.col("minct" if first else "maxct")
            if c == "id" and not first:
                return F.col("last_id")
            keep = c in source and (first or c in self.spec.entity)
            return F.col(source[c]) if keep else F.lit(None).cast(kind[c])

        rows = F.array(
            *[F.struct(*[column(c, first).cast(kind[c]).alias(c) for c in self.spec.log_columns]) for first in (True, False)]
        )
        # A session of its enter row alone has no other last row.
        alone = place("minct", "maxindex").eqNullSafe(place("maxct", "last_id"))
        return sessions.select(F.explode(F.when(alone, F.slice(rows, 1, 1)).otherwise(rows)).alias("r")).select("r.*")

    # -- a run

    def run(self, log: DataFrame, heartbeat: DataFrame, position: Mapping | None = None) -> Batch:
        """Take rows that were not taken before, in any order of time; the run's number."""
        spec = self.spec
        done = self.commits.batches()
        number = (0, done[-1][1] + 1 if done else 0)
        scratch = shared_folder(self.spark, "sessions-run")

        def kept(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{scratch}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

        try:
            new = kept(S.union_rows(log, heartbeat, spec).distinct(), "new")
            log_schema, session_schema, entity_schema = self._schemas(new)
            version = F.lit(number[1]).cast("bigint").alias("version")
            met = new.groupBy(*spec.entity).agg(
                F.min(F.when(F.col("at").isNotNull(), place())).alias("low_new"),
                F.max(F.when(F.col("at").isNotNull(), place())).alias("high_new"),
                (F.max(spec.peak) if spec.peak else F.lit(None).cast("double")).alias("peak_new"),
            )
            state = kept(self._of(met, self._newest_entities(entity_schema), "left"), "state")
            is_late = F.coalesce(F.col("low_new") <= F.col("high"), F.lit(False))
            carried = state.filter(~is_late & F.col("last").isNotNull()).select("last.*")
            late = state.filter(is_late).select(*spec.entity)
            old, again = carried.select(*self.session), None
            if not late.isEmpty():
                stored = kept(self._of(self._newest_sessions(session_schema), late).select(*self.session), "stored")
                old, again = old.union(stored), self._stretches(new, stored, late, kept)
            summaries = old
            rows = new
            if again is not None:
                inside = F.coalesce(F.col("reread"), F.lit(False)) & _within(place("minct", "maxindex"))
                summaries = self._of(old, again, "left").filter(~inside).select(*self.session)
                rows = rows.union(self._stored_rows(log_schema, again))
            rows = kept(rows.union(self._log_shaped(summaries, new.schema)), "rows")
            found = kept(S.clean_runs(rows, self.plain, self.rows_per_slice).select(*self.session, "is_open"), "found")
            last = found.filter("is_open").select(*spec.entity, F.struct(*self.session).alias("now"))
            after = self._of(state, last, "left").select(
                *spec.entity,
                F.greatest("high", "high_new").alias("high"),
                F.greatest("peak", "peak_new").alias("peak"),
                F.coalesce("now", "last").alias("last"),
                version,
            )
            self.rows.write(new.repartitionByRange("ct").sortWithinPartitions("ct"), number)
            self.sessions.write(found.select(*self.session).exceptAll(old).select("*", version), number)
            self.entities.write(after, number)
            were_open = state.filter(F.col("last").isNotNull()).select("last.*")
            self.closed.write(self._closed(found, old, were_open, after), number)
            self.commits.add(number, dict(position or {}))
        finally:
            drop_folder(self.spark, scratch)
        return number

    def _closed(self, found: DataFrame, old: DataFrame, were_open: DataFrame, after: DataFrame) -> DataFrame:
        """Sessions that this run closed, and those closed before whose end it changed (``again``), in
        the columns of the job; the peak is the entity's up to now."""
        key = [*self.opening, "minct"]
        named = lambda df, *more: df.select(*[F.col(c).alias(f"__k_{c}") for c in key], *more)
        same = F.lit(True)
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        closed_before = old.join(named(were_open), same, "left_anti")
        now = found.filter(~F.col("is_open")).join(named(closed_before, F.col("maxct").alias("__end")), same, "left")
        changed = now.filter(F.col("__end").isNull() | (F.col("__end") != F.col("maxct")))
        peak = [F.col("peak").alias("maxsp")] if self.spec.peak else []
        return self._of(changed, after.select(*self.spec.entity, "peak"), "left").select(
            *self.opening, *peak, "minct", "maxct", F.col("__end").isNotNull().alias("again")
        )

    def _stretches(self, new: DataFrame, stored: DataFrame, late: DataFrame, kept) -> DataFrame | None:
        """Per entity with a session that a new enter row cuts: from the first such session (null: from
        the beginning) to the end of the last one (null: to the end); None if there is none."""
        spec = self.spec
        enters = self._of(new.filter("at = 1"), late).select(*spec.entity, "ct", "id")
        start, end = place("minct", "maxindex"), place("maxct", "last_id")
        nothing = F.lit(None).cast(stored.select(start.alias("s")).schema["s"].dataType)
        mark = lambda at, first, last: [F.lit(at).alias("at"), first.alias("first"), last.alias("end")]
        marks = (
            enters.select(*spec.entity, "ct", "id", *mark(1, nothing, nothing))
            .union(stored.select(*spec.entity, F.col("minct"), F.col("maxindex"), *mark(1, start, end)))
            .union(stored.filter(~start.eqNullSafe(end)).select(*spec.entity, F.col("maxct"), F.col("last_id"), *mark(0, start, end)))
        )
        # A run that a new enter row begins and a stored last row ends lies in a session it cuts.
        runs = S.runs_between(kept(marks, "marks"), spec, ["first", "end"], self.rows_per_slice)
        cut = runs.filter("s.first is null and e.first is not null").select(*spec.entity, F.col("e.first").alias("low"), F.col("e.end").alias("upto"))
        # So does one at the very place of a stored enter row.
        same = enters.select(*[F.col(c).alias(f"__{c}") for c in (*spec.entity, "ct", "id")]).distinct()
        match = F.col("minct").eqNullSafe(F.col("__ct")) & F.col("maxindex").eqNullSafe(F.col("__id"))
        for c in spec.entity:
            match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
        tied = stored.join(same, match, "left_semi").select(*spec.entity, start.alias("low"), end.alias("upto"))
        # Before the first session stand rows that belong to none, until an enter row comes before them.
        firsts = stored.groupBy(*spec.entity).agg(F.min(F.struct(start.alias("start"), end.alias("end"))).alias("first"))
        earliest = self._of(enters.groupBy(*spec.entity).agg(F.min(place()).alias("enter")), firsts, "left")
        before = earliest.filter(F.col("first").isNull() | (F.col("enter") < F.col("first.start")))
        lead = before.select(*spec.entity, nothing.alias("low"), F.col("first.end").alias("upto"), F.lit(True).alias("leads"))
        every = cut.union(tied).withColumn("leads", F.lit(False)).union(lead)
        found = kept(
            every.groupBy(*spec.entity).agg(
                F.bool_or("leads").alias("leads"), F.bool_or(F.col("leads") & F.col("upto").isNull()).alias("all"),
                F.min("low").alias("low"), F.max("upto").alias("upto"),
            ).select(
                *spec.entity, F.when(~F.col("leads"), F.col("low")).alias("low"),
                F.when(~F.col("all"), F.col("upto")).alias("upto"), F.lit(True).alias("reread"),
            ),
            "stretches",
        )
        return None if found.isEmpty() else found

    def _stored_rows(self, schema: str, stretches: DataFrame) -> DataFrame:
        """Rows of the stretches; the earliest and latest time of all bound the scan."""
        lo, hi, from_start, to_end = stretches.agg(
            F.min("low.ct"), F.max("upto.ct"), F.bool_or(F.col("low").isNull()), F.bool_or(F.col("upto").isNull())
        ).first()
        rows = self.rows.read(schema)
        rows = rows if from_start else rows.filter(F.col("ct") >= F.lit(lo))
        rows = rows if to_end else rows.filter(F.col("ct") <= F.lit(hi))
        return self._of(rows, stretches, "inner").filter(_within(place())).select(*self.spec.log_columns)

    # -- what it has come to

    def closed_in(self, number: Batch, log: DataFrame) -> DataFrame:
        """What a run closed or changed after closing (``again``); ``log`` gives the types."""
        return self.closed.read_some([number], self._closed_schema(log))

    def position(self) -> dict:
        """The source positions noted by the last run."""
        done = self.commits.batches()
        return self.commits.content(done[-1]) if done else {}

    def current(self, log: DataFrame) -> DataFrame:
        """All sessions with ``is_open``, in the columns of the job; ``log`` gives the types."""
        _, session_schema, entity_schema = self._schemas(log)
        entities = self._newest_entities(entity_schema)
        joined = self._of(self._newest_sessions(session_schema), entities, "left")
        is_open = F.struct(*self.opening, "minct").eqNullSafe(F.struct(*[F.col(f"last.{c}").alias(c) for c in (*self.opening, "minct")]))
        peak = [F.col("peak").alias("maxsp")] if self.spec.peak else []
        return joined.select(*self.opening, *peak, "minct", "maxct", is_open.alias("is_open"))
