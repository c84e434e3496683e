"""Leaderboard, set, key/value, hash and list jobs with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from studytrail.operators import boards as B
from studytrail.operators import keyvalues as K
from studytrail.operators import lists as L
from studytrail.operators import sets as Z
from studytrail.plans import fixtures as X
from studytrail.plans.registry import Registry, ctes
from studytrail.runtime import stored


def _on(fixture, make):
    """A query on one derived table."""
    return lambda spark, sf_dir: make(fixture(X.tables(spark, sf_dir)("events")))


# Leaderboards. Members to look up are all customers; most are on no board.

BOARDS = ctes("boards")
RANKED = f"""{ctes('boards').rstrip()}, r as (select *,
 row_number() over (partition by board order by score, member)-1 as rank,
 row_number() over (partition by board order by score desc, member desc)-1 as revrank,
 count(*) over (partition by board) as size from boards)"""
ASKED = """select concat('board_', cast(c_nationkey%3 as varchar)) as board,
 cast(c_custkey as varchar) as member from customer"""


def _asked(spark, sf_dir):
    customer = X.tables(spark, sf_dir)("customer")
    return customer.select(
        F.concat(F.lit("board_"), (F.col("c_nationkey") % 3).cast("string")).alias("board"),
        F.col("c_custkey").cast("string").alias("member"),
    )


def _boards(make):
    return _on(X.boards, make)


def _ranked_boards(make):
    """Ranks look at the boards several times, so these are stored first."""
    return _on(X.boards, lambda boards: make(stored(boards, "boards")))


def _boards_asked(make):
    return lambda spark, sf_dir: make(X.boards(X.tables(spark, sf_dir)("events")), _asked(spark, sf_dir))


def _register_boards(reg: Registry) -> None:
    def add(name, make, sql):
        reg.add(name, _boards(make), sql)

    def add_ranked(name, make, sql):
        reg.add(name, _ranked_boards(make), sql)

    add(
        "lb_topk",
        lambda b: B.top_k(b, 10),
        f"{RANKED} select board, member, score, revrank as rank from r where revrank<10",
    )
    add_ranked(
        "lb_position",
        lambda b: B.by_position(b, 2, -3, desc=True),
        f"{RANKED} select board, member, score, revrank as rank from r where revrank>=2 and revrank<=size-3",
    )
    add_ranked(
        "lb_position_tail",
        lambda b: B.by_position(b, -5, -1),
        f"{RANKED} select board, member, score, rank from r where rank>=size-5",
    )
    add(
        "lb_range",
        lambda b: B.by_score(b, 5, 10),
        f"{BOARDS} select board, member, score from boards where score between 5 and 10",
    )
    page = "(select *, row_number() over (partition by board order by {o}) as place from boards where score between 3 and 9) z"
    add(
        "lb_range_page",
        lambda b: B.by_score(b, 3, 9, offset=4, count=6),
        f"{BOARDS} select board, member, score from {page.format(o='score, member')} where place between 5 and 10",
    )
    add_ranked(
        "lb_range_page_desc",
        lambda b: B.by_score(b, 3, 9, desc=True, offset=4),
        f"{BOARDS} select board, member, score from {page.format(o='score desc, member desc')} where place>4",
    )
    add(
        "lb_count_range",
        lambda b: B.count_by_score(b, 5, 10),
        f"{BOARDS} select board, count(case when score between 5 and 10 then 1 end) as n, count(*) as size from boards group by 1",
    )
    add_ranked("lb_rank", lambda b: B.with_ranks(b).drop("revrank"), f"{RANKED} select board, member, score, rank, size from r")
    add_ranked(
        "lb_rank_sliced",
        lambda b: B.with_ranks(b, rows_per_slice=40).drop("revrank"),
        f"{RANKED} select board, member, score, rank, size from r",
    )
    reg.add(
        "lb_revrank",
        _boards_asked(lambda b, a: B.rank_of(stored(b, "boards"), a, desc=True)),
        f"{RANKED} select r.board, r.member, revrank as rank from r join ({ASKED}) a on a.board=r.board and a.member=r.member",
    )
    reg.add(
        "lb_score",
        _boards_asked(B.scores_of),
        f"""{BOARDS} select a.board, a.member, coalesce(score, 0) as score from ({ASKED}) a
 left join boards b on a.board=b.board and a.member=b.member""",
    )
    reg.add(
        "lb_incr",
        _boards_asked(lambda b, a: B.increment(b, a.withColumn("delta", F.lit(2.5)))),
        f"""{BOARDS} select board, member, sum(score) as score from (select * from boards union all
 select board, member, 2.5 from ({ASKED}) a) u group by 1, 2""",
    )
    reg.add(
        "lb_upsert",
        _boards_asked(lambda b, a: B.upsert(b, a.withColumn("score", F.length("member") * F.lit(1.5)))),
        f"""{BOARDS}, a as ({ASKED}) select board, member, cast(length(member)*1.5 as double) as score from a union all
 select board, member, score from boards b where not exists
 (select 1 from a where a.board=b.board and a.member=b.member)""",
    )
    reg.add(
        "lb_remove",
        _boards_asked(B.remove_members),
        f"""{BOARDS}, a as ({ASKED}) select board, member, score from boards b where not exists
 (select 1 from a where a.board=b.board and a.member=b.member)""",
    )
    add(
        "lb_drop",
        lambda b: B.drop_boards(b, ["board_1"]),
        f"{BOARDS} select board, member, score from boards where board<>'board_1'",
    )
    add_ranked(
        "lb_remove_range",
        lambda b: B.remove_by_position(b, 0, -11),
        f"{RANKED} select board, member, score from r where rank>size-11",
    )
    add(
        "lb_remove_score",
        lambda b: B.remove_by_score(b, 5, 10),
        f"{BOARDS} select board, member, score from boards where not (score between 5 and 10)",
    )
    both = "from boards where board in ('board_0','board_2') group by member"
    add(
        "lb_union",
        lambda b: B.union_boards(b, ["board_0", "board_2"], "sum"),
        f"{BOARDS} select 'sum' as board, member, sum(score) as score {both}",
    )
    add(
        "lb_intersect",
        lambda b: B.intersect_boards(b, ["board_0", "board_2"], "sum"),
        f"{BOARDS} select 'sum' as board, member, sum(score) as score {both} having count(*)=2",
    )


SETS = ctes("member_sets")


def _register_sets(reg: Registry) -> None:
    def add(name, make, sql):
        reg.add(name, _on(X.member_sets, make), sql)

    of = "select member from member_sets where key='{k}'"
    keys = ("click", "view", "error")
    inter = " intersect ".join(of.format(k=k) for k in keys)
    union = " union ".join(of.format(k=k) for k in keys)
    diff = " except ".join(of.format(k=k) for k in keys)
    add("set_inter", lambda s: Z.intersect(s, keys), f"{SETS} {inter}")
    add("set_union", lambda s: Z.union(s, keys), f"{SETS} {union}")
    add("set_diff", lambda s: Z.difference(s, keys[0], keys[1:]), f"{SETS} {diff}")
    rest = "select key, member from member_sets where key<>'signup'"
    for name, op, sql in (("inter", Z.intersect, inter), ("union", Z.union, union)):
        add(
            f"set_{name}_store",
            lambda s, op=op: Z.store(s, op(s, keys), "signup"),
            f"{SETS} {rest} union all select 'signup', member from ({sql}) z",
        )
    add(
        "set_diff_store",
        lambda s: Z.store(s, Z.difference(s, keys[0], keys[1:]), "signup"),
        f"{SETS} {rest} union all select 'signup', member from ({diff}) z",
    )
    add(
        "set_add",
        lambda s: Z.add(s, s.filter(F.col("key") == "view").withColumn("key", F.lit("click"))),
        f"{SETS} select key, member from member_sets union select 'click', member from member_sets where key='view'",
    )
    add(
        "set_remove",
        lambda s: Z.remove(s, s.filter(F.col("key") == "view").withColumn("key", F.lit("click"))),
        f"""{SETS} select key, member from member_sets where key<>'click' or member not in
 (select member from member_sets where key='view')""",
    )
    add(
        "set_move",
        lambda s: Z.move(s, s.select(F.lit("click").alias("key"), F.lit("view").alias("dest"), "member")),
        f"{SETS} select key, member from member_sets where key<>'click' union select 'view', member from member_sets where key='click'",
    )
    add("set_card", Z.cardinality, f"{SETS} select key, count(*) as n from member_sets group by 1")
    add(
        "set_member",
        lambda s: Z.contains(s, s.select(F.lit("click").alias("key"), "member").distinct()),
        f"""{SETS} select 'click' as key, m.member, c.member is not null as found from (select distinct member from member_sets) m
 left join member_sets c on c.key='click' and c.member=m.member""",
    )
    add("set_members", lambda s: Z.members(s, "error"), f"{SETS} {of.format(k='error')}")
    h = "md5(concat('7:', key, ':', member))"
    place = f"select key, member, row_number() over (partition by key order by {h}, member) as rn from member_sets"
    add("set_random", lambda s: Z.random_members(s, 5, 7), f"{SETS} select key, member from ({place}) z where rn<=5")
    add("set_pop", lambda s: Z.pop(s, 5, 7)[1], f"{SETS} select key, member from ({place}) z where rn>5")
    add(
        "set_random_repeats",
        lambda s: Z.random_draws(stored(s, "members"), 6, 7),
        f"""{SETS.rstrip()}, m as (select key, member, row_number() over (partition by key order by member)-1 as pos,
 count(*) over (partition by key) as size from member_sets)
 select m.key, draw, member from m join (select cast(unnest as integer) as draw from unnest([1,2,3,4,5,6])) d
 on pos = cast(concat('0x', substr(md5(concat('7:', key, ':', cast(draw as varchar))), 1, 15)) as bigint) % size""",
    )


PAIRS = ctes("pairs")
WANTED = "select concat('click:', cast(c_custkey as varchar)) as key from customer"


def _wanted(spark, sf_dir):
    customer = X.tables(spark, sf_dir)("customer")
    return customer.select(F.concat(F.lit("click:"), F.col("c_custkey").cast("string")).alias("key"))


def _pairs(make):
    return _on(X.pairs, make)


def _pairs_wanted(make):
    return lambda spark, sf_dir: make(X.pairs(X.tables(spark, sf_dir)("events")), _wanted(spark, sf_dir))


def _valued(keys):
    return keys.withColumn("value", F.concat(F.lit("v_"), F.col("key")))


def _register_pairs(reg: Registry) -> None:
    absent = "key not in (select key from pairs)"
    new = "select key, concat('v_', key) as value from w"
    both = f"{PAIRS.rstrip()}, w as ({WANTED})"
    reg.add(
        "kv_multi_get",
        _pairs_wanted(K.multi_get),
        f"{both} select w.key, pairs.value from w left join pairs on pairs.key=w.key",
    )
    reg.add(
        "kv_multi_set",
        _pairs_wanted(lambda t, w: K.multi_set(t, _valued(w))),
        f"{both} select key, value from pairs where key not in (select key from w) union all {new}",
    )
    reg.add(
        "kv_set_if_absent",
        _pairs_wanted(lambda t, w: K.set_if_absent(t, _valued(w))),
        f"{both} select key, value from pairs union all {new} where {absent}",
    )
    reg.add(
        "kv_set_all_or_none",
        _pairs_wanted(lambda t, w: K.set_all_or_none(t, _valued(w))),
        f"{both} select key, value from pairs union all {new} where not exists (select 1 from pairs p join w x on x.key=p.key)",
    )
    reg.add(
        "kv_set_all_new",
        _pairs_wanted(lambda t, w: K.set_all_or_none(t, _valued(w.withColumn("key", F.concat(F.lit("new:"), F.col("key")))))),
        f"{both} select key, value from pairs union all select concat('new:', key), concat('v_new:', key) from w",
    )
    reg.add(
        "kv_incr",
        _pairs_wanted(lambda t, w: K.increment(t, w.withColumn("delta", F.lit(5)))),
        f"""{both} select key, cast(cast(sum(n) as bigint) as varchar) as value from (select key, cast(value as bigint) as n
 from pairs union all select key, 5 from w) u group by 1""",
    )
    reg.add(
        "kv_keys",
        _pairs(lambda t: K.matching_keys(t, "[cs]*:1?")),
        f"{PAIRS} select key from pairs where regexp_full_match(key, '[cs].*:1.')",
    )
    reg.add(
        "kv_exists",
        _pairs_wanted(K.exists),
        f"{both} select key, key in (select key from pairs) as found from w",
    )
    reg.add("kv_delete", _pairs_wanted(K.delete_keys), f"{both} select key, value from pairs where key not in (select key from w)")


HASHES = ctes("hashes")


def _register_hashes(reg: Registry) -> None:
    def add(name, make, sql):
        reg.add(name, _on(X.hashes, make), sql)

    # Changes for one field of every hash; the value is that of its clicks.
    def clicks(h, field):
        return h.filter(F.col("field") == "click").select("key", F.lit(field).alias("field"), F.col("value"))

    def of(field):
        return f"select key, '{field}' as field, value from hashes where field='click'"

    add(
        "hs_get",
        lambda h: K.hash_get(h, ["click", "view", "none"]),
        f"""{HASHES} select key, max(case when field='click' then value end) as click, max(case when field='view' then value end)
 as "view", cast(null as varchar) as none from hashes group by 1""",
    )
    add(
        "hs_rows",
        lambda h: K.hash_rows(h, ["user_1", "user_20"]),
        f"{HASHES} select key, field, value from hashes where key in ('user_1','user_20')",
    )
    add("hs_keys", lambda h: K.hash_keys(h, "user_3"), f"{HASHES} select field from hashes where key='user_3'")
    add("hs_values", lambda h: K.hash_values(h, "user_3"), f"{HASHES} select value from hashes where key='user_3'")
    add("hs_size", K.hash_size, f"{HASHES} select key, count(*) as n from hashes group by 1")
    add(
        "hs_exists",
        lambda h: K.hash_has(h, h.select("key", F.lit("error").alias("field")).distinct()),
        f"""{HASHES} select key, 'error' as field, bool_or(field='error') as found from hashes group by 1""",
    )
    add(
        "hs_put",
        lambda h: K.hash_put(h, clicks(h, "view")),
        f"""{HASHES} select key, field, value from hashes where not (field='view' and key in
 (select key from hashes where field='click')) union all {of('view')}""",
    )
    add(
        "hs_put_if_absent",
        lambda h: K.hash_put(h, clicks(h, "view").unionByName(clicks(h, "extra")), if_absent=True),
        f"""{HASHES} select key, field, value from hashes union all {of('view')} and key not in
 (select key from hashes where field='view') union all {of('extra')}""",
    )
    add(
        "hs_delete",
        lambda h: K.hash_delete(h, clicks(h, "error")),
        f"{HASHES} select key, field, value from hashes where not (field='error' and key in (select key from hashes where field='click'))",
    )
    add(
        "hs_incr",
        lambda h: K.hash_increment(h, clicks(h, "bonus").withColumnRenamed("value", "delta").unionByName(
            clicks(h, "click").withColumnRenamed("value", "delta"))),
        f"""{HASHES} select key, field, cast(cast(sum(n) as bigint) as varchar) as value from (select key, field,
 cast(value as bigint) as n from hashes union all select key, unnest(['bonus','click']), cast(value as bigint)
 from hashes where field='click') u group by 1, 2""",
    )


def _lists_sql(order: str = "pos") -> str:
    return f"""{ctes('lists').rstrip()}, r as (select *, row_number() over (partition by key order by {order})-1 as idx,
 count(*) over (partition by key) as size from lists)"""


def _register_lists(reg: Registry) -> None:
    def add(name, make, sql):
        reg.add(name, _on(X.lists, make), sql)

    add("ls_range", lambda x: L.list_range(x, 2, -3), f"{_lists_sql()} select key, idx, value from r where idx>=2 and idx<=size-3")
    add(
        "ls_range_sliced",
        lambda x: L.list_range(x, 2, -3, rows_per_slice=30),
        f"{_lists_sql()} select key, idx, value from r where idx>=2 and idx<=size-3",
    )
    add("ls_index", lambda x: L.list_index(x, -2), f"{_lists_sql()} select key, idx, value from r where idx=size-2")
    add("ls_length", L.list_length, f"{ctes('lists')} select key, count(*) as n from lists group by 1")
    add("ls_trim", lambda x: L.list_trim(x, -10, -1), f"{_lists_sql()} select key, pos, value from r where idx>=size-10")
    hits = f"""{ctes('lists').rstrip()}, h as (select *, row_number() over (partition by key, value order by pos {{d}}) as rn from lists)
 select key, pos, value from h where value<>'click' or rn>{{n}}"""
    add("ls_remove_head", lambda x: L.list_remove(x, 3, "click"), hits.format(d="", n=3))
    add("ls_remove_tail", lambda x: L.list_remove(x, -2, "click"), hits.format(d="desc", n=2))
    add("ls_remove_all", lambda x: L.list_remove(x, 0, "click"), f"{ctes('lists')} select key, pos, value from lists where value<>'click'")
    add(
        "ls_sort_alpha",
        lambda x: L.list_sort(x, offset=3, count=8, alpha=True),
        f"{_lists_sql('value, pos')} select key, idx, value from r where idx>=3 and idx<11",
    )
    numbers = ctes("lists", numbers="select key, pos, cast((pos * 37) % 113 as varchar) as value from lists").rstrip()
    reg.add(
        "ls_sort",
        _on(X.lists, lambda x: L.list_sort(stored(x.withColumn("value", (F.col("pos") * 37 % 113).cast("string")), "numbers"))),
        f"""{numbers} select key, row_number() over (partition by key order by cast(value as double), value, pos)-1 as idx, value
 from numbers""",
    )
    add(
        "ls_sort_desc",
        lambda x: L.list_sort(x, desc=True, alpha=True),
        f"{_lists_sql('value desc, pos desc')} select key, idx, value from r",
    )


def register(reg: Registry) -> None:
    for part in (_register_boards, _register_sets, _register_pairs, _register_hashes, _register_lists):
        part(reg)
