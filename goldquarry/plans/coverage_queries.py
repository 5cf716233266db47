"""Catalogue queries: coverage, gaps, cross-tabs and facets."""

from pyspark.sql import functions as F

from goldquarry import fixed_values as fv
from goldquarry.operators import coverage
from goldquarry.plans import frames as fr
from goldquarry.plans import oracle_views as ov
from goldquarry.plans.registry import query

PRESENCE = "CASE WHEN drone_present THEN 'yes' WHEN NOT drone_present THEN 'no' ELSE 'uncertain' END"
CONFUSER_CELL = "CASE WHEN len(possible_confusers) > 0 THEN array_to_string(possible_confusers, ', ') ELSE 'none' END"


def _coverage_sql(source: str) -> str:
    scalar = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, coalesce({d}, 'unknown') AS value FROM {source}"
        for d in ("drone_visibility", "background", "lighting", "blur_bucket")
    )
    return f"""
    entries AS (
      SELECT 'drone_present' AS dimension, {PRESENCE} AS value FROM {source} UNION ALL {scalar} UNION ALL
      SELECT 'possible_confusers', unnest(CASE WHEN len(possible_confusers) > 0 THEN possible_confusers
                                               ELSE ['none'] END) FROM {source}
    ),
    coverage AS (SELECT dimension, value, count(*) AS count FROM entries GROUP BY ALL)"""


@query(
    "coverage_counts",
    f"""WITH {ov.FRAMES}, {_coverage_sql('frames')}
    SELECT *, count < 10 AS has_gap FROM coverage""",
)
def coverage_counts(spark, sf):
    return coverage.coverage(fr.frames(spark, sf), min_count=10)


@query(
    "golden_coverage_gaps",
    f"""WITH {ov.GOLDEN}, {_coverage_sql('golden')}
    SELECT dimension, value, count, 60 AS min_count FROM coverage WHERE count < 60""",
)
def golden_coverage_gaps(spark, sf):
    """Which conditions are under-represented in the trusted set?"""
    return coverage.gaps(coverage.coverage(fr.golden(spark, sf)), min_count=60)


@query(
    "coverage_gaps",
    f"""WITH {ov.FRAMES}, {_coverage_sql('frames')}
    SELECT dimension, value, count, 100 AS min_count FROM coverage WHERE count < 100""",
)
def coverage_gaps(spark, sf):
    return coverage.gaps(coverage.coverage(fr.frames(spark, sf)), min_count=100)


@query(
    "coverage_order_priorities",
    """WITH entries AS (
      SELECT 'o_orderpriority' AS dimension, o_orderpriority AS value FROM orders UNION ALL
      SELECT 'o_orderstatus', o_orderstatus FROM orders
    )
    SELECT dimension, value, count(*) AS count, count(*) < 5 AS has_gap FROM entries GROUP BY ALL""",
)
def coverage_order_priorities(spark, sf):
    return coverage.coverage(fr.table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus", "absent"])


@query(
    "facet_values",
    f"""WITH {ov.FRAMES}
    SELECT DISTINCT 'source_split' AS facet, source_split AS value FROM frames UNION ALL
    SELECT DISTINCT 'drone_present', CASE WHEN drone_present THEN 'True' ELSE 'False' END FROM frames WHERE drone_present IS NOT NULL UNION ALL
    SELECT DISTINCT 'drone_visibility', drone_visibility FROM frames WHERE drone_visibility IS NOT NULL UNION ALL
    SELECT DISTINCT 'background', background FROM frames WHERE background <> 'unknown'""",
)
def facet_values(spark, sf):
    return coverage.facet_values(fr.frames(spark, sf))


def _cells_sql(source: str, pairs) -> str:
    label = lambda c: {
        "drone_present": PRESENCE, "possible_confusers": CONFUSER_CELL
    }.get(c, f"coalesce({c}, 'None')")
    return " UNION ALL ".join(
        f"SELECT '{a}_x_{b}' AS tab, {label(a)} AS l, {label(b)} AS r FROM {source}"
        + (" WHERE drone_visibility IS NOT NULL" if seen else "")
        for a, b, seen in pairs
    )


MARGINS_SQL = """
  SELECT tab, CASE WHEN grouping(l) = 1 THEN 'All' ELSE l END AS left_value,
         CASE WHEN grouping(r) = 1 THEN 'All' ELSE r END AS right_value,
         grouping(l) = 1 AS left_margin, grouping(r) = 1 AS right_margin, count(*) AS count
  FROM cells GROUP BY GROUPING SETS ((tab, l, r), (tab, l), (tab, r), (tab))"""


@query(
    "key_crosstabs",
    f"WITH {ov.FRAMES}, cells AS ({_cells_sql('frames', fv.KEY_CROSSTABS)}) {MARGINS_SQL}",
)
def key_crosstabs(spark, sf):
    return coverage.crosstabs(fr.frames(spark, sf))


@query(
    "crosstab_margins",
    f"""WITH {ov.FRAMES}, cells AS ({_cells_sql('frames', [('drone_visibility', 'background', False)])})
    SELECT left_value, right_value, count FROM ({MARGINS_SQL})""",
)
def crosstab_margins(spark, sf):
    return coverage.crosstab(fr.frames(spark, sf), "drone_visibility", "background")


@query(
    "crosstab_wide",
    f"""WITH {ov.FRAMES}
    SELECT CASE WHEN grouping(background) = 1 THEN 'All' ELSE background END AS background,
           {", ".join(f"count(*) FILTER (lighting = '{v}') AS {v}" for v in fv.LIGHTINGS)}, count(*) AS "All"
    FROM frames GROUP BY GROUPING SETS ((background), ())""",
)
def crosstab_wide(spark, sf):
    return coverage.crosstab_wide(fr.frames(spark, sf), "background", "lighting", fv.LIGHTINGS)
