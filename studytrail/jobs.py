"""The platform's jobs, ready to submit: log tables to session tables, topics to
reports, dimension tables and other topics. Connection settings come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studytrail.operators import sessions as S
from studytrail.operators.slices import ROWS_PER_SLICE
from studytrail.runtime import drop_folder, shared_folder
from studytrail.sources import jdbc, topics
from studytrail.streaming import relay, reports
from studytrail.streaming.commits import CommitLog
from studytrail.streaming.offsets import resume_offsets, starting_offsets
from studytrail.streaming.publish import Publisher
from studytrail.streaming.sessions import SessionStore

# Fixed table names and column families of the platform.
HEARTBEAT_TABLE = "r_timestat"
SESSION_TABLES = {
    "login": ("r_loginop", "session_login", S.LOGIN),
    "course": ("r_courseop", "session_course", S.COURSE),
    "activity": ("r_activityop", "session_course_activity", S.ACTIVITY),
    "homework": ("r_homeworkop", "session_course_homework", S.HOMEWORK),
    "video": ("r_actionopvidio", "session_course_resource", S.VIDEO),
    "document": ("r_docop", "session_course_resource", S.DOCUMENT),
    "live": ("r_liveop", "session_course_resource", S.LIVE),
    "pictext": ("r_pictxtop", "session_course_resource", S.PICTEXT),
}
RELAYS = {"a": relay.relay_a, "b": relay.relay_b}
DIMENSIONS = {
    "question_point": (reports.question_point_cells, "qp"),
    "paper_task": (reports.paper_task_cells, "i"),
}

# The id of its enter row and its start name a session; four jobs share one table.
SESSION_KEYS = {name: ("maxindex", *spec.entity, "minct") for name, (_, _, spec) in SESSION_TABLES.items()}


class Staging:
    """Copies in the shared folder, removed at the end: a source is read once, however
    many jobs work on it, and rows to append do not change while they are appended."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            drop_folder(self.spark, path)

    def copy(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_folder(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def session_jobs(
    spark: SparkSession,
    connection: Mapping[str, str],
    names: Sequence[str],
    mode: str = "clean",
    partitions: int = 200,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> None:
    """Session jobs that share one reading of the heartbeats, which are split by time.

    clean mode appends the sessions that an enter row has closed and that are not stored yet, so
    a stored end never changes; sessions still open replace those of the run before in a table
    beside the target (``open_table``). compat mode appends everything, as a rerun of the
    original does."""
    columns = list(dict.fromkeys(c for name in names for c in SESSION_TABLES[name][2].heartbeat))
    with Staging(spark) as staging:
        beats = jdbc.read_table_by_range(spark, connection, HEARTBEAT_TABLE, "ct", partitions)
        beats = staging.copy(beats.select(*columns), "heartbeat")
        for name in names:
            log_table, target, spec = SESSION_TABLES[name]
            log = jdbc.read_table_by_range(spark, connection, log_table, "id", partitions)
            log = staging.copy(log.select(*spec.log_columns), f"{name}-log")
            found = S.sessionize(log, beats.select(*spec.heartbeat), spec, mode, rows_per_slice, mode == "clean")
            if mode == "compat":
                jdbc.append_table(found, connection, target)
                continue
            found = staging.copy(found, f"{name}-sessions")
            closed = found.filter(~F.col("is_open")).drop("is_open")
            jdbc.append_new(spark, closed, connection, target, SESSION_KEYS[name], partitions)
            jdbc.replace_table(found.filter("is_open").drop("is_open"), connection, open_table(name))


def incremental_session_jobs(
    spark: SparkSession,
    connection: Mapping[str, str],
    names: Sequence[str],
    state: str,
    partitions: int = 200,
    rows_per_slice: int = ROWS_PER_SLICE,
    heartbeat_position: str = "ct",
) -> None:
    """Clean session jobs that read only rows beyond those of the run before. Their sessions are kept
    under ``state``; a job appends the sessions a run closed to its target, those closed before
    whose end late rows moved to ``changed_table``, and replaces its open ones.

    The log is taken by ``id``, the heartbeats by ``heartbeat_position``: a column that grows in the
    order of arrival. With the time of the heartbeat itself, those that arrive late are missed."""
    columns = list(dict.fromkeys(c for name in names for c in SESSION_TABLES[name][2].heartbeat))
    with Staging(spark) as staging:
        for name in names:
            log_table, target, spec = SESSION_TABLES[name]
            store = SessionStore(spark, f"{state.rstrip('/')}/{name}", spec, rows_per_slice)
            position = store.position()
            beats = _beyond(spark, connection, HEARTBEAT_TABLE, heartbeat_position, position.get("heartbeat"), partitions)
            beats = staging.copy(beats.select(*dict.fromkeys((*columns, heartbeat_position))), f"{name}-heartbeat")
            log = _beyond(spark, connection, log_table, "id", position.get("log"), partitions)
            log = staging.copy(log.select(*spec.log_columns), f"{name}-log")
            reached = {"log": log.agg(F.max("id")).first()[0], "heartbeat": beats.agg(F.max(heartbeat_position)).first()[0]}
            # Times are noted as text.
            known = {k: position.get(k) if v is None else v if isinstance(v, (int, float)) else str(v) for k, v in reached.items()}
            store.run(log, beats.select(*spec.heartbeat), known)
            _deliver(spark, connection, store, name, log, partitions)
            still_open = store.current(log).filter("is_open").drop("is_open")
            jdbc.replace_table(staging.copy(still_open, f"{name}-open"), connection, open_table(name))


def _beyond(spark, connection, table: str, column: str, value, partitions: int) -> DataFrame:
    return jdbc.read_table_by_range(spark, connection, jdbc.rows_beyond(table, column, value), column, partitions)


def _deliver(spark, connection, store: SessionStore, name: str, log: DataFrame, partitions: int) -> None:
    """Append what the runs closed and no earlier job delivered. A delivery that began before and did
    not end is made up: its rows go only where their key is missing."""
    _, target, _ = SESSION_TABLES[name]
    began, ended = CommitLog(spark, f"{store.root}/deliveries-begun"), CommitLog(spark, f"{store.root}/deliveries")
    begun = set(began.batches())
    for batch in sorted(set(store.commits.batches()) - set(ended.batches())):
        rows = store.closed_in(batch, log)
        parts = ((target, ~F.col("again"), SESSION_KEYS[name]), (changed_table(name), F.col("again"), (*SESSION_KEYS[name], "maxct")))
        if batch not in begun:
            began.add(batch, {})
        for table, which, keys in parts:
            some = rows.filter(which).drop("again")
            if batch in begun:
                jdbc.append_new(spark, some, connection, table, keys, partitions)
            else:
                jdbc.append_table(some, connection, table)
        ended.add(batch, {})


def changed_table(name: str) -> str:
    """Where a job appends closed sessions again whose end has changed; the last one counts."""
    return f"{SESSION_TABLES[name][1]}_{name}_changed"


def open_table(name: str) -> str:
    """Where a job keeps the sessions that are still open."""
    return f"{SESSION_TABLES[name][1]}_{name}_open"


def relay_job(
    spark: SparkSession,
    servers: str,
    which: str,
    source: str,
    target: str,
    checkpoint: str,
    starting: str = "latest",
) -> StreamingQuery:
    """Topic to topic; a restart goes on from the checkpoint."""
    records = topics.kafka_stream(spark, topics.kafka_source_options(servers, source, starting))
    writer = topics.to_kafka(RELAYS[which](records, target), servers, checkpoint)
    return topics.trigger(writer, topics.RELAY_INTERVALS[which]).start()


# Records of one batch; a first start on a long topic otherwise takes all of it at once.
MAX_PER_BATCH = 50_000_000


def report_job(
    spark: SparkSession,
    servers: str,
    topic: str,
    root: str,
    mode: str = "clean",
    seconds: int = 5,
    max_per_batch: int = MAX_PER_BATCH,
    checkpoint: str | None = None,
    earliest: Mapping[int, int] | None = None,
) -> StreamingQuery:
    """The running answer report of a topic of answers. A new ``checkpoint`` starts at the offsets
    that the report has applied, given the ``earliest`` ones the broker still has."""
    report = reports.AnswerReport(spark, root, mode, ordered=True, checkpoint=checkpoint)
    saved = {r.partition: r.offset for r in report.positions.resume().filter(F.col("topic") == topic).collect()}
    starting = starting_offsets(topic, resume_offsets(saved, earliest or {})) if saved else "earliest"
    options = topics.kafka_source_options(servers, topic, starting, max_per_batch)
    return topics.trigger(report.writer(topics.kafka_stream(spark, options)), seconds).start()


def publish_job(
    spark: SparkSession, root: str, points_path: str, tasks_path: str, mode: str = "clean", compact: bool = False
) -> None:
    """Summary cells and leaderboards of the learners whose answers came since the last run, with
    the dimensions of both feeds; ``compact`` also folds the finished batches of report and
    tables. To be run on a schedule beside ``report_job``."""
    report = reports.AnswerReport(spark, root, mode)
    publisher = Publisher(report, points_path, tasks_path)
    publisher.run()
    if compact:
        publisher.compact()
        report.compact(before=report.cells.batches()[-1] if report.cells.batches() else None)


def dimension_job(
    spark: SparkSession,
    servers: str,
    topic: str,
    dimension: str,
    path: str,
    seconds: int = 5,
    max_per_batch: int = MAX_PER_BATCH,
) -> StreamingQuery:
    """A dimension feed (a key of DIMENSIONS) into its cell table."""
    to_cells, family = DIMENSIONS[dimension]
    options = topics.kafka_source_options(servers, topic, "earliest", max_per_batch)
    records = topics.kafka_stream(spark, options)
    return topics.trigger(reports.feed_cells(spark, records, to_cells, path, family), seconds).start()
