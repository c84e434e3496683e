"""Answer reports and leaderboards with their SQL, the compat reports as running windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from studytrail.functions.keys import outcome, text_count
from studytrail.operators import answers as A
from studytrail.operators import boards as B
from studytrail.plans import fixtures as X
from studytrail.plans.registry import Registry, ctes

# Learners and sittings are numbers, so the first row key in byte order is the smallest text.
_FIRST_TASK = """select testPaper_user_id as tpu, cast(split_part(k,'_',2) as bigint) as task_id,
 cast(split_part(k,'_',3) as bigint) as customs_id from (select testPaper_user_id,
 min(concat(cast(testPaper_user_id as varchar),'_',cast(TaskID as varchar),'_',cast(CustomsID as varchar))) as k
 from paper_task group by 1) f"""

_VALID = """select a.log_offset as n, a.CreateUser as user_id, a.TestPaper_User_ID as tpu, a.QuestionID as qid,
 a.IsRight as r, t.task_id, t.customs_id from answers a left join ft t on a.TestPaper_User_ID=t.tpu
 where a.IsRight is not null"""

BASE = ctes("answers", "question_point", "paper_task", ft=_FIRST_TASK, v=_VALID).rstrip()

KEYS = {"paper": ("user_id", "tpu"), "customs": ("user_id", "customs_id")}
KEY_NAME = {"paper": "testpaper_user_id", "customs": "customs_id"}
KEY_WHERE = {"paper": "true", "customs": "customs_id>0"}


def clean_summary_sql(kind: str) -> str:
    k1, k2 = KEYS[kind]
    where = KEY_WHERE[kind]
    task = "min(task_id)" if kind == "paper" else "arg_min(task_id, n)"
    return f"""{BASE},
 q as (select {k1}, {k2}, count(distinct qid) as q_count, count(distinct case when r=1 then qid end) as q_r_count,
  count(distinct case when r=0 then qid end) as q_f_count, {task} as task_id, min(customs_id) as cus
  from v where {where} group by 1, 2),
 p as (select {k1}, {k2}, count(distinct PointId) as p_count, count(distinct case when r=1 then PointId end) as p_r_count,
  count(distinct case when r=0 then PointId end) as p_f_count
  from v join question_point x on x.QuestionId=v.qid where {where} group by 1, 2)
 select q.{k1}, q.{k2} as {KEY_NAME[kind]}, q_count, q_r_count, q_f_count, coalesce(p_count,0) as p_count,
  coalesce(p_r_count,0) as p_r_count, coalesce(p_f_count,0) as p_f_count,
  cast(q_r_count as double)/q_count as accuracy, case when task_id>0 then task_id end as TaskID,
  case when cus>0 then cus end as CustomsID
 from q left join p on p.{k1}=q.{k1} and p.{k2}=q.{k2}"""


def _running_sql(kind: str) -> str:
    """Counters after every event of a key, from windows over the events before it."""
    k1, k2 = KEYS[kind]
    before = f"over (partition by {k1}, {k2} order by n rows between unbounded preceding and 1 preceding)"
    s = kind[0]
    where = KEY_WHERE[kind]
    return f"""{s}1 as (select *, row_number() over (partition by {k1}, {k2}, qid order by n)=1 as newq from v where {where}),
 {s}x as (select e.n, e.r, row_number() over (partition by e.{k1}, e.{k2}, x.PointId order by e.n)=1 as newp
  from {s}1 e join question_point x on x.QuestionId=e.qid),
 {s}p as (select n, count(*) as pts, count(case when newp then 1 end) as newp,
  count(case when newp and r<>0 then 1 end) as newpr, count(case when newp and r=0 then 1 end) as newpf
  from {s}x group by n),
 {s}2 as (select e.*, coalesce(pts,0) as pts, coalesce(newp,0) as newp, coalesce(newpr,0) as newpr,
  coalesce(newpf,0) as newpf from {s}1 e left join {s}p on {s}p.n=e.n),
 {s}3 as (select *, coalesce(sum(case when newq then 1 else 0 end) {before},0)+1 as q_count,
  coalesce(sum(case when newq and r<>0 then 1 else 0 end) {before},0)+case when r=1 then 1 else 0 end as q_r_count,
  coalesce(sum(case when newq and r=0 then 1 else 0 end) {before},0)+case when r=1 then 0 else 1 end as q_f_count,
  coalesce(sum(newp) {before},0)+pts as p_count,
  coalesce(sum(newpr) {before},0)+case when r=1 then pts else 0 end as p_r_count,
  coalesce(sum(newpf) {before},0)+case when r=1 then 0 else pts end as p_f_count,
  row_number() over (partition by {k1}, {k2} order by n desc) as back from {s}2)"""


def _big(names, alias: str = "") -> str:
    return ", ".join(f"cast({alias}{c} as bigint) as {c}" for c in names)


def compat_summary_sql(kind: str) -> str:
    if kind == "paper":
        return f"""{BASE}, {_running_sql('paper')}
 select user_id, tpu as testpaper_user_id, {_big(A.COUNTS)}, cast(q_r_count as double)/cast(q_count as double) as accuracy,
  case when task_id>0 then task_id end as TaskID, case when customs_id>0 then customs_id end as CustomsID
 from p3 where back=1"""
    both = ", ".join(f"cast(c.{c}+p.{c} as bigint) as {c}" for c in A.COUNTS)
    return f"""{BASE}, {_running_sql('paper')}, {_running_sql('customs')},
 f as (select c.user_id, c.customs_id, {both} from c3 c join p3 p on p.n=c.n where c.back=1)
 select *, cast(q_r_count as double)/cast(q_count as double) as accuracy from f"""


def clean_cells_sql(kind: str, item: str) -> str:
    k1, k2 = KEYS[kind]
    join = "" if item == "question" else "join question_point x on x.QuestionId=v.qid"
    col = "qid" if item == "question" else "cast(PointId as bigint)"
    return f"""{BASE}
 select {k1}, {k2} as {KEY_NAME[kind]}, {col} as {item}_id, count(*) as attempts,
  count(case when r=1 then 1 end) as "right", count(case when r=0 then 1 end) as wrong
 from v {join} where {KEY_WHERE[kind]} group by 1, 2, 3"""


def compat_cells_sql(kind: str, item: str) -> str:
    k1, k2 = KEYS[kind]
    join = "" if item == "question" else "join question_point x on x.QuestionId=v.qid"
    col = "qid" if item == "question" else "PointId"
    family = item[0]
    suffix_n = "sum(case when (r=0)=(first_r=0) then 1 else 0 end)" if item == "question" else "1"
    return f"""{BASE},
 e as (select concat(cast({k1} as varchar),'_',cast({k2} as varchar)) as rowkey, cast({col} as varchar) as name, r,
  first_value(r) over (partition by {k1}, {k2}, {col} order by n) as first_r
  from v {join} where {KEY_WHERE[kind]})
 select rowkey, '{family}' as family, name as qualifier, cast(count(*) as varchar) as value from e group by rowkey, name
 union all
 select rowkey, '{family}', concat(name, case when first_r=0 then '_0' else '_1' end), cast({suffix_n} as varchar)
 from e group by rowkey, name, first_r"""


def _inputs(spark, sf_dir):
    table = X.tables(spark, sf_dir)
    events = table("events")
    return X.answers(events), X.question_points(table("part")), X.paper_tasks(events)


def _summary(kind: str, mode: str):
    def run(spark, sf_dir):
        answers, points, tasks = _inputs(spark, sf_dir)
        make = A.paper_summary if kind == "paper" else A.customs_summary
        return make(A.question_cells(answers, mode), points, tasks, mode).drop("last_seq")

    return run


def _cells(kind: str, item: str, mode: str):
    def run(spark, sf_dir):
        answers, points, tasks = _inputs(spark, sf_dir)
        cells, keys = A.question_cells(answers, mode), A.PAPER
        if kind == "customs":
            cells, keys = A.customs_cells(cells, tasks), A.CUSTOMS
        if item == "point":
            cells = A.point_cells(cells, points, keys)
        if mode == "compat":
            return A.counter_rows(cells, keys, f"{item}_id", item[0])
        return cells.select(*keys, f"{item}_id", "attempts", "right", "wrong")

    return run


def _boards(make):
    def run(spark, sf_dir):
        answers, points, tasks = _inputs(spark, sf_dir)
        return make(answers, points, tasks)

    return run


def _accuracy(kind: str, mode: str):
    def make(answers, points, tasks):
        cells = A.question_cells(answers, mode)
        if kind == "task":
            return B.accuracy_scores(A.paper_summary(cells, points, tasks, mode), "TaskID", B.TASK_ACCURACY)
        return B.accuracy_scores(A.customs_summary(cells, points, tasks, mode), "customs_id", B.CUSTOMS_ACCURACY)

    return _boards(make)


def _accuracy_count(answers, points, tasks):
    """Learners per task whose accuracy is at least one half."""
    report = A.paper_summary(A.question_cells(answers), points, tasks)
    return B.count_by_score(B.accuracy_scores(report, "TaskID", B.TASK_ACCURACY), 0.5, 1.0)


def score_sql(column: str, prefix: str) -> str:
    return f"""{BASE} select concat('{prefix}', cast({column} as varchar)) as board, cast(user_id as varchar) as member,
 cast(count(*) as double) as score from v where r=1 and {column}>0 group by 1, 2"""


def accuracy_sql(kind: str, mode: str) -> str:
    if kind == "task":
        inner = (clean_summary_sql if mode == "clean" else compat_summary_sql)("paper")
        # The last write per (task, user) is that of the sitting answered last.
        return f"""with rep as ({inner}), last as (select CreateUser as user_id, TestPaper_User_ID as tpu,
 max(event_id) as n from (select event_id, user_id as CreateUser, user_id*4+event_id%4 as TestPaper_User_ID from events
 where event_type<>'error') z group by 1, 2)
 select concat('{B.TASK_ACCURACY}', cast(TaskID as varchar)) as board, cast(user_id as varchar) as member, accuracy as score
 from (select rep.TaskID, rep.user_id, rep.accuracy, row_number() over (partition by rep.TaskID, rep.user_id order by n desc) as rn
 from rep join last on last.user_id=rep.user_id and last.tpu=rep.testpaper_user_id where TaskID>0) y where rn=1"""
    inner = (clean_summary_sql if mode == "clean" else compat_summary_sql)("customs")
    return f"""with rep as ({inner}) select concat('{B.CUSTOMS_ACCURACY}', cast(customs_id as varchar)) as board,
 cast(user_id as varchar) as member, accuracy as score from rep"""


def _outcomes(spark, sf_dir):
    """Stored compat cells read back: counts by outcome per learner and sitting."""
    answers, _, _ = _inputs(spark, sf_dir)
    rows = A.counter_rows(A.question_cells(answers, "compat"), A.PAPER, "question_id", "q")
    return rows.groupBy("rowkey", outcome(F.col("qualifier")).alias("outcome")).agg(
        F.sum(text_count(F.col("value"))).alias("n")
    )


def _outcomes_sql() -> str:
    kind = "case when qualifier like '%$_0' escape '$' then 'wrong' when qualifier like '%$_1' escape '$' then 'right' else 'total' end"
    return f"""select rowkey, {kind} as outcome, cast(sum(cast(value as bigint)) as bigint) as n
 from ({compat_cells_sql('paper', 'question')}) c group by 1, 2"""


def register(reg: Registry) -> None:
    for kind in ("paper", "customs"):
        reg.add(f"rep_{kind}_summary_clean", _summary(kind, "clean"), clean_summary_sql(kind))
        reg.add(f"rep_{kind}_summary_compat", _summary(kind, "compat"), compat_summary_sql(kind))
        for item in ("question", "point"):
            reg.add(f"rep_{kind}_{item}_cells_clean", _cells(kind, item, "clean"), clean_cells_sql(kind, item))
            reg.add(f"rep_{kind}_{item}_cells_compat", _cells(kind, item, "compat"), compat_cells_sql(kind, item))
    reg.add("rep_outcomes", _outcomes, _outcomes_sql())
    reg.add("lb_task_score", _boards(lambda a, p, t: B.task_scores(a, t)), score_sql("task_id", B.TASK_SCORE))
    reg.add("lb_customs_score", _boards(lambda a, p, t: B.customs_scores(a, t)), score_sql("customs_id", B.CUSTOMS_SCORE))
    reg.add("lb_sitting_score", _boards(lambda a, p, t: B.sitting_scores(a)), score_sql("tpu", B.TASK_SCORE).replace("tpu>0", "tpu is not null"))
    for kind in ("task", "customs"):
        reg.add(f"lb_{kind}_accuracy", _accuracy(kind, "clean"), accuracy_sql(kind, "clean"))
        reg.add(f"lb_{kind}_accuracy_compat", _accuracy(kind, "compat"), accuracy_sql(kind, "compat"))
    reg.add(
        "lb_accuracy_count",
        _boards(_accuracy_count),
        f"""select board, count(case when score between 0.5 and 1 then 1 end) as n, count(*) as size
 from ({accuracy_sql('task', 'clean')}) q group by 1""",
    )
