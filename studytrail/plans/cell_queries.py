"""Wide-column scans and changes with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from studytrail.functions import predicates as P
from studytrail.operators import cellfilters as C
from studytrail.plans import fixtures as X
from studytrail.plans.registry import Registry, ctes
from studytrail.runtime import stored, temporary_folder
from studytrail.sources import celltables

# Versions asked for, among the newest of each table size.
VERSIONS = [*range(30, 40), *range(390, 400), *range(3990, 4000)]

CELLS = ctes("cells")
ALL = f"{CELLS} select rowkey, family, qualifier, version, value from cells"


def _cells(make):
    return lambda spark, sf_dir: make(X.cells(X.tables(spark, sf_dir)("events")))


def _table(make):
    """Filters on whole rows scan the cells twice, so these are a stored table."""
    return _cells(lambda cells: make(stored(cells, "cells")))


def _versions(make):
    return lambda spark, sf_dir: make(X.cell_versions(X.tables(spark, sf_dir)("events")))



def _ordered(window: str, keep: str, where: str = "true") -> str:
    return f"""{CELLS} select rowkey, family, qualifier, version, value from
 (select *, {window} as rn from cells where {where}) z where {keep}"""


ROW_ORDER = "row_number() over (partition by rowkey order by family, qualifier)"


def _comparators(cells):
    v, q = F.col("value"), F.col("qualifier")
    return cells.select(
        *C.COLUMNS,
        P.test(v, "<", P.binary("5")).alias("lt"),
        P.test(v, "<=", P.binary("50")).alias("le"),
        P.test(v, "=", P.binary_prefix("10")).alias("prefix"),
        P.test(v, ">", P.binary_prefix("10")).alias("prefix_gt"),
        P.test(v, "!=", P.binary("102")).alias("ne"),
        P.test(v, ">=", P.binary("90")).alias("ge"),
        P.test(v, "=", P.bits("5", "xor")).alias("bit_xor"),
        P.test(v, "!=", P.bits("2", "and")).alias("bit_and"),
        P.test(v, "=", P.null()).alias("is_null"),
        P.test(q, "=", P.regex("c[lh]")).alias("rx"),
        P.test(q, "!=", P.substring("IE")).alias("sub"),
    )


COMPARATORS_SQL = f"""{CELLS} select rowkey, family, qualifier, version, value, value<'5' as lt, value<='50' as le,
 substr(value,1,2)='10' as prefix, substr(value,1,2)>'10' as prefix_gt, value<>'102' as ne, value>='90' as ge,
 length(value)=1 and xor(ascii(value), ascii('5'))<>0 as bit_xor,
 not (length(value)=1 and (ascii(value) & ascii('2'))<>0) as bit_and, value is null as is_null,
 regexp_matches(qualifier,'c[lh]') as rx, not contains(lower(qualifier),'ie') as sub from cells"""


def _changes(cells):
    """One change per click cell: an older or newer version."""
    return cells.filter(F.col("qualifier") == "click").select(
        "rowkey",
        "family",
        "qualifier",
        (F.col("version") + F.when(F.col("family") == "course", 1).otherwise(-1)).alias("version"),
        F.concat(F.lit("new"), F.col("value")).alias("value"),
    )


def register(reg: Registry) -> None:
    def add(name, make, sql):
        reg.add(name, _cells(make), sql)

    def add_table(name, make, sql):
        reg.add(name, _table(make), sql)

    add("wc_01", lambda c: C.family_filter(c, "<=", P.binary("grc")), f"{ALL} where family<='grc'")
    add("wc_02", lambda c: C.qualifier_filter(c, "<=", P.binary("p")), f"{ALL} where qualifier<='p'")
    add("wc_03", lambda c: C.row_filter(c, "<=", P.binary("u00000075")), f"{ALL} where rowkey<='u00000075'")
    add("wc_04", lambda c: C.prefix_filter(c, "u0000001"), f"{ALL} where starts_with(rowkey,'u0000001')")
    add("wc_05", lambda c: C.row_regex(c, ".*1[0-4]$"), f"{ALL} where regexp_matches(rowkey,'1[0-4]$')")
    add("wc_05_suffix", lambda c: C.suffix_filter(c, "01"), f"{ALL} where ends_with(rowkey,'01')")
    add("wc_06", lambda c: C.column_prefix(c, "pu"), f"{ALL} where starts_with(qualifier,'pu')")
    add(
        "wc_07",
        lambda c: C.column_prefix(c, "cl", "si"),
        f"{ALL} where starts_with(qualifier,'cl') or starts_with(qualifier,'si')",
    )
    add("wc_08", lambda c: C.column_count(c, 2), _ordered(ROW_ORDER, "rn<=2"))
    add("wc_08_row", lambda c: C.column_count(c, 2, "u00000007"), _ordered(ROW_ORDER, "rn<=2 and rowkey='u00000007'"))
    add("wc_09", lambda c: C.column_page(c, 2, 1, "course"), _ordered(ROW_ORDER, "rn in (2,3)", "family='course'"))
    add(
        "wc_10",
        lambda c: C.column_range(c, "click", "signup", False, True),
        f"{ALL} where qualifier>'click' and qualifier<='signup'",
    )
    dependent = """ where exists (select 1 from cells r where r.rowkey=cells.rowkey and r.version=cells.version
 and r.family='course' and r.qualifier='click' {test})"""
    add_table("wc_11", lambda c: C.dependent_column(c, "course", "click"), ALL + dependent.format(test=""))
    add_table(
        "wc_11_value",
        lambda c: C.dependent_column(c, "course", "click", True, "<", P.binary("6")),
        ALL + dependent.format(test="and r.value<'6'") + " and not (family='course' and qualifier='click')",
    )
    add("wc_12", C.first_key_only, _ordered(ROW_ORDER, "rn=1"))
    add(
        "wc_13",
        lambda c: C.fuzzy_row(c, "u00000000", [0] * 7 + [1, 0]),
        f"{ALL} where rowkey like 'u000000_0'",
    )
    add("wc_14", lambda c: C.inclusive_stop(c, "u00000100"), f"{ALL} where rowkey<='u00000100'")
    add(
        "wc_15",
        lambda c: C.key_only(c, True),
        f"{CELLS} select rowkey, family, qualifier, version, cast(strlen(value) as varchar) as value from cells",
    )
    add("wc_15_empty", C.key_only, f"{CELLS} select rowkey, family, qualifier, version, '' as value from cells")
    add_table(
        "wc_16",
        lambda c: C.first_rows(c, 2),
        f"{ALL} where rowkey in (select distinct rowkey from cells order by rowkey limit 2)",
    )
    add(
        "wc_17",
        lambda c: C.random_rows(c, 0.5, 7),
        f"{ALL} where cast(concat('0x', substr(md5(concat('7:', rowkey)),1,8)) as bigint)/4294967296.0 < 0.5",
    )
    failing = "(select rowkey from cells where family='course' and qualifier='click' and not {test})"
    add_table(
        "wc_18",
        lambda c: C.single_column_value(c, "course", "click", ">=", P.binary("5")),
        f"{ALL} where rowkey not in {failing.format(test='(value>=' + chr(39) + '5' + chr(39) + ')')}",
    )
    add_table(
        "wc_19",
        lambda c: C.single_column_value(c, "course", "click", "=", P.substring("9"), exclude=True),
        f"{ALL} where rowkey not in {failing.format(test='contains(value, ' + chr(39) + '9' + chr(39) + ')')}"
        " and not (family='course' and qualifier='click')",
    )
    add("wc_20", lambda c: C.value_filter(c, "!=", P.binary("102")), f"{ALL} where value<>'102'")
    add_table(
        "wc_21",
        lambda c: C.skip_rows(c, P.test(F.col("value"), "!=", P.binary("102"))),
        f"{ALL} where rowkey not in (select rowkey from cells where value='102')",
    )
    add("wc_22", lambda c: C.timestamps(c, VERSIONS), f"{ALL} where version in {tuple(VERSIONS)}")
    add_table(
        "wc_23",
        lambda c: C.while_match(c, P.test(F.col("value"), "!=", P.binary("101"))),
        f"""{CELLS}, bad as (select rowkey, family, qualifier from cells where value='101'
 order by rowkey, family, qualifier limit 1)
 select c.rowkey, c.family, c.qualifier, c.version, c.value from cells c left join bad b on true
 where b.rowkey is null or (c.rowkey, c.family, c.qualifier) < (b.rowkey, b.family, b.qualifier)""",
    )
    either = [
        C.ColumnTest("course", "click", "<", P.binary("4")),
        C.ColumnTest("info", "view", ">=", P.binary("7")),
    ]
    fail_1 = "(select rowkey from cells where family='course' and qualifier='click' and not value<'4')"
    fail_2 = "(select rowkey from cells where family='info' and qualifier='view' and not value>='7')"
    add_table(
        "wc_24",
        lambda c: C.row_tests(c, either, any_pass=True),
        f"{ALL} where rowkey not in {fail_1} or rowkey not in {fail_2}",
    )
    add_table(
        "wc_24_all",
        lambda c: C.row_tests(c, either),
        f"{ALL} where rowkey not in {fail_1} and rowkey not in {fail_2}",
    )
    add(
        "wc_24_cells",
        lambda c: C.any_of(c, F.col("rowkey").startswith("u0000001"), P.test(F.col("qualifier"), ">=", P.binary("p"))),
        f"{ALL} where starts_with(rowkey,'u0000001') or qualifier>='p'",
    )
    add("wc_25", _comparators, COMPARATORS_SQL)

    add("cell_get", lambda c: C.get_rows(c, ["u00000003", "u00000010"]), f"{ALL} where rowkey in ('u00000003','u00000010')")
    add("cell_scan", lambda c: C.scan_family(c, "course", "click"), f"{ALL} where family='course' and qualifier='click'")
    add(
        "cell_fields",
        lambda c: C.column_as_field(c, [("course", "click"), ("info", "view")]),
        f"""{CELLS} select rowkey, max(case when family='course' and qualifier='click' then value end) as course_click,
 max(case when family='info' and qualifier='view' then value end) as info_view from cells
 where (family='course' and qualifier='click') or (family='info' and qualifier='view') group by 1""",
    )
    add(
        "cell_upsert",
        lambda c: C.put(c, _changes(c)),
        f"""{CELLS} select rowkey, family, qualifier, case when qualifier='click' and family='course' then version+1
 else version end as version, case when qualifier='click' and family='course' then concat('new', value) else value end
 as value from cells""",
    )
    versions = "with all_v as (" + X.FIXTURE_SQL["cell_versions"] + "), v as (select rowkey, family, qualifier, seq as version, value from all_v)"
    reg.add(
        "cell_latest",
        _versions(lambda v: C.latest(v.select(*C.CELL, F.col("seq").alias("version"), "value"))),
        f"""{versions} select rowkey, family, qualifier, version, value from (select *, row_number() over
 (partition by rowkey, family, qualifier order by version desc) as rn from v) z where rn=1""",
    )
    newest = f"""{versions} select rowkey, family, qualifier, version, value from (select *, row_number() over
 (partition by rowkey, family, qualifier order by version desc) as rn from v) z where rn=1"""
    reg.add(
        "cell_get_stored",
        _stored_cells(20, lambda spark, sf_dir, cells: C.get_rows(cells, _nation_keys(spark, sf_dir))),
        f"{newest} and rowkey in (select concat('u', lpad(cast(n_nationkey as varchar), 8, '0')) from nation)",
    )
    reg.add(
        "cell_fuzzy_stored",
        _stored_cells(4, lambda spark, sf_dir, cells: C.fuzzy_row(cells, "u00000000", [0] * 7 + [1, 0])),
        f"{newest} and rowkey like 'u000000_0'",
    )
    reg.add(
        "cell_delete",
        _versions(_delete_clicks),
        f"""{versions} select rowkey, family, qualifier, version, value from (select *, row_number() over
 (partition by rowkey, family, qualifier order by version desc) as rn from v) z where rn>1 or qualifier<>'click'""",
    )


def _stored_cells(batches: int, choose):
    """Current cells among those chosen from a stored table, whose versions came in several batches."""

    def run(spark, sf_dir):
        path = temporary_folder(spark, "cells")
        versions = X.cell_versions(X.tables(spark, sf_dir)("events"))
        cells = versions.select(*C.CELL, F.col("seq").alias("version"), "value")
        celltables.create_table(spark, path, ["course", "info"])
        for n in range(batches):
            celltables.put_cells(spark, path, cells.filter(F.col("version") % batches == n), (0, n))
        return C.latest(choose(spark, sf_dir, celltables.all_versions(spark, path)))

    return run


def _nation_keys(spark, sf_dir):
    number = F.col("n_nationkey").cast("string")
    return X.tables(spark, sf_dir)("nation").select(F.concat(F.lit("u"), F.lpad(number, 8, "0")).alias("rowkey"))


def _delete_clicks(versions):
    cells = versions.select(*C.CELL, F.col("seq").alias("version"), "value")
    return C.delete_newest(cells, cells.filter(F.col("qualifier") == "click"))
