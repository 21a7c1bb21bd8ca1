"""Registered queries of the coast network and of the infill between run-up segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilframe import network
from perilframe.operators import joins, sequence
from perilframe.plans import infill
from perilframe.plans import tsunami as TS
from perilframe.plans.registry import CLUSTER, NODES, RSEG, _lengths, _runup_segments, c, query, r6

#: Run-ups below this height amplify in the queries: the view's heights are spread evenly over 0 to 5 m.
LOW, HIGH = 0.2, 3.0
AMP = f"amp AS (SELECT DISTINCT event_id, part_id, station_m AS s FROM snap WHERE h >= {LOW} AND h < {HIGH})"
GAPS = "gp AS (SELECT * FROM (SELECT event_id, part_id, s1 AS g0, lead(s0) OVER (PARTITION BY event_id, part_id ORDER BY s0) AS g1 FROM rseg) WHERE g1 > g0)"


def _near(at: str, ahead: bool) -> str:
    return f"(SELECT {'min' if ahead else 'max'}(s) FROM amp WHERE amp.event_id = gp.event_id AND amp.part_id = gp.part_id AND s {'>=' if ahead else '<'} {at})"


def _low(runup, coast):
    return sequence.in_band(TS.events_snapped(runup, coast), "h", LOW, HIGH).select("event_id", "part_id", "station_m")


def _rounded(df, *names):
    return df.select(*(F.round(n, 3).alias(n) if n in ("g0", "g1", "s0", "s1", "c0", "c1", "left_to", "right_from", "seed_at", "longest_m", "station_a", "station_b", "length_m") else n for n in names))


DECIDED = f"""{RSEG}, {AMP}, {GAPS},
nb AS (SELECT gp.*, {_near('g0', False)} AS lb, {_near('g0', True)} AS la, {_near('g1', False)} AS rb, {_near('g1', True)} AS ra, (SELECT count(*) FROM amp WHERE amp.event_id = gp.event_id AND amp.part_id = gp.part_id) AS k FROM gp),
pc AS (SELECT *, g1 - g0 <= 150000.0 AS whole, CASE WHEN g1 - g0 > 150000.0 AND la > g0 AND la - g0 <= 60000.0 THEN la END AS left_to, CASE WHEN g1 - g0 > 150000.0 AND rb < g1 AND g1 - rb <= 60000.0 THEN rb END AS right_from,
  coalesce(g0 - lb <= 60000.0, false) OR coalesce(la - g0 <= 60000.0, false) AS l, coalesce(g1 - rb <= 60000.0, false) OR coalesce(ra - g1 <= 60000.0, false) AS r FROM nb),
dc AS (SELECT *, whole OR left_to IS NOT NULL OR right_from IS NOT NULL AS passed, CASE WHEN whole THEN 'unconditional' WHEN left_to IS NOT NULL OR right_from IS NOT NULL THEN CASE WHEN l AND r THEN 'amp_both_edges_ok' WHEN l THEN 'amp_left_ok' ELSE 'amp_right_ok' END
  WHEN l OR r THEN 'amp_near_edge_but_subgap_too_long' WHEN k = 0 THEN 'no_amplifiers_available' ELSE 'no_amplifiers_near_edges' END AS reason FROM pc)"""


def _decided(runup, coast):
    return infill.rulebased_decisions(_runup_segments(runup, coast), infill.amplifiers(_low(runup, coast)), 150_000.0, 60_000.0)


@query(f"WITH {DECIDED} SELECT event_id, part_id, round(g0, 3) AS g0, round(g1, 3) AS g1, round(left_to, 3) AS left_to, round(right_from, 3) AS right_from, passed, reason FROM dc", "fx_runup", "fx_coast_vertex")
def infill_rulebased(runup, coast):
    return _rounded(_decided(runup, coast), "event_id", "part_id", "g0", "g1", "left_to", "right_from", "passed", "reason")


@query(f"""WITH {DECIDED}, pi AS (SELECT event_id, part_id, g0 AS a, g1 AS b FROM dc WHERE whole UNION ALL SELECT event_id, part_id, g0, left_to FROM dc WHERE left_to IS NOT NULL UNION ALL SELECT event_id, part_id, right_from, g1 FROM dc WHERE right_from IS NOT NULL),
il AS (SELECT *, sum(CASE WHEN a - m <= 1.0 THEN 0 ELSE 1 END) OVER (PARTITION BY event_id, part_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, max(b) OVER (PARTITION BY event_id, part_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM pi))
SELECT event_id, part_id, round(min(a), 3) AS s0, round(max(b), 3) AS s1 FROM il GROUP BY event_id, part_id, g""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def infill_bridges(runup, coast):
    return _rounded(infill.rulebased_bridges(_decided(runup, coast)), "event_id", "part_id", "s0", "s1")


EVIDENCE = f"""{RSEG}, {CLUSTER}, g AS (SELECT event_id, part_id, cluster, min(station_m) AS c0, max(station_m) AS c1, count(*) AS n FROM cl GROUP BY 1, 2, 3),
v AS (SELECT g.*, CASE WHEN c1 > c0 THEN coalesce((SELECT sum(greatest(0.0, least(s1, c1) - greatest(s0, c0))) FROM rseg WHERE rseg.event_id = g.event_id AND rseg.part_id = g.part_id), 0) / greatest(1.0, c1 - c0) ELSE 0.0 END AS cover,
  (SELECT max(s1) FROM rseg WHERE rseg.event_id = g.event_id AND rseg.part_id = g.part_id AND s1 <= c0) AS lf, (SELECT min(s0) FROM rseg WHERE rseg.event_id = g.event_id AND rseg.part_id = g.part_id AND s0 >= c1) AS rt,
  (SELECT count(*) FROM rseg WHERE rseg.event_id = g.event_id AND rseg.part_id = g.part_id AND s0 <= c1 AND s1 >= c0) AS touch FROM g)"""


@query(f"WITH {EVIDENCE} SELECT event_id, part_id, n, round(c0, 3) AS c0, round(c1, 3) AS c1, round(cover, 6) AS cover FROM v WHERE n > 1 AND c1 > c0", "fx_runup", "fx_coast_vertex")
def interval_coverage(runup, coast):
    points = TS.events_snapped(runup, coast).select("event_id", "part_id", "station_m")
    found = infill.evidence_clusters(points, _runup_segments(runup, coast), 50_000.0).where("n > 1 AND c1 > c0")
    return found.select("event_id", "part_id", "n", F.round("c0", 3).alias("c0"), F.round("c1", 3).alias("c1"), r6(c("cover")).alias("cover"))


@query(f"""WITH {EVIDENCE}, hb AS (SELECT v.*, EXISTS (SELECT 1 FROM bb WHERE bb.event_id = v.event_id AND bb.part_id = v.part_id) AS has FROM v)
SELECT event_id, part_id, round(c0, 3) AS c0, round(c1, 3) AS c1, n, reason NOT IN ('min_samples', 'no_base_for_part', 'no_left_or_right', 'bridge_gap_large', 'cover_too_small') AS accepted, reason FROM (
  SELECT *, CASE WHEN n < 2 AND n <> 1 THEN 'min_samples' WHEN cover >= 0.5 THEN 'majority' WHEN rt - lf <= 150000.0 THEN 'bridge' WHEN least(c0 - lf, rt - c1) <= 150000.0 THEN 'one_side' WHEN touch > 0 THEN 'overlap'
    WHEN c1 <= c0 AND lf IS NULL AND rt IS NULL AND has THEN 'proximity' WHEN NOT has THEN 'seed' WHEN lf IS NULL OR rt IS NULL THEN 'no_left_or_right' WHEN rt - lf > 150000.0 THEN 'bridge_gap_large' ELSE 'cover_too_small' END AS reason FROM hb)""".replace("rseg WHERE", "bb WHERE").replace("rseg.event_id", "bb.event_id").replace("rseg.part_id", "bb.part_id").replace(", cl AS", ", bb AS (SELECT event_id, part_id, round(s0, 3) AS s0, round(s1, 3) AS s1 FROM rseg WHERE s1 - s0 > 15000.0), cl AS").replace("FROM snap)", "FROM (SELECT * REPLACE (round(station_m, 3) AS station_m) FROM snap))"), "fx_runup", "fx_coast_vertex")  # fmt: skip
def infill_evidence(runup, coast):
    """Long segments as the base, and every run-up as evidence, with all ways of acceptance switched on; places in whole millimetres, as many
    run-ups and segments end where their part does."""
    points = TS.events_snapped(runup, coast).select("event_id", "part_id", F.round("station_m", 3).alias("station_m"))
    base = _runup_segments(runup, coast).where(c("s1") - c("s0") > 15_000.0).select("event_id", "part_id", F.round("s0", 3).alias("s0"), F.round("s1", 3).alias("s1"))
    found = infill.evidence_clusters(points, base, 50_000.0, bridge_m=150_000.0, zero_cover=True, one_side=True, singletons=True, seed_m=30_000.0)
    return _rounded(found, "event_id", "part_id", "c0", "c1", "n", "accepted", "reason")


SCORED = f"""{RSEG}, {AMP}, {GAPS}, sc AS (SELECT *, e - 0.7 * pow((g1 - g0) / 300000.0, 1.2) AS score FROM (SELECT *, CAST(coalesce(least(coalesce(abs(lb - g0), 1e18), coalesce(abs(la - g0), 1e18)) <= 60000.0, false) AS INT) + CAST(coalesce(least(coalesce(abs(rb - g1), 1e18), coalesce(abs(ra - g1), 1e18)) <= 60000.0, false) AS INT) AS e
  FROM (SELECT gp.*, {_near('g0', False)} AS lb, {_near('g0', True)} AS la, {_near('g1', False)} AS rb, {_near('g1', True)} AS ra, (SELECT arg_min(s, struct_pack(f := greatest(s - g0, g1 - s), s := s)) FROM amp WHERE amp.event_id = gp.event_id AND amp.part_id = gp.part_id AND s > g0 AND s < g1) AS seed FROM gp) WHERE g1 - g0 <= 300000.0)),
sr AS (SELECT *, CASE WHEN g1 - g0 <= 30000.0 THEN 'unconditional' WHEN greatest(seed - g0, g1 - seed) <= 30000.0 THEN 'seed' WHEN g1 - g0 <= 120000.0 AND score >= 0.2 THEN 'tier_1' WHEN g1 - g0 <= 210000.0 AND score >= 0.35 THEN 'tier_2' WHEN score >= 0.5 THEN 'tier_3' ELSE 'score_too_small' END AS reason FROM sc)"""


def _scored(runup, coast):
    return infill.scored_gaps(_runup_segments(runup, coast), _low(runup, coast), _lengths(coast), 60_000.0, 120_000.0, 300_000.0, free_m=30_000.0)


@query(f"""WITH {SCORED} SELECT event_id, sr.part_id, round(g0, 3) AS g0, round(g1, 3) AS g1, e AS edges, round(score, 6) AS score, reason, round(CASE WHEN reason = 'seed' THEN seed END, 3) AS seed_at,
  round(CASE WHEN reason <> 'score_too_small' THEN greatest(0.0, g0 - 60000.0) END, 3) AS s0, round(CASE WHEN reason <> 'score_too_small' THEN least(length_m, g1 + 60000.0) END, 3) AS s1 FROM sr JOIN len ON len.part_id = sr.part_id""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def infill_scored(runup, coast):
    rows = _scored(runup, coast).withColumn("score", r6(c("score")))
    return _rounded(rows, "event_id", "part_id", "g0", "g1", "edges", "score", "reason", "seed_at", "s0", "s1")


def _islands(name: str, source: str, gap: float) -> str:
    """A common table of the intervals (event_id, part_id, a, b) of another one, merged."""
    return f"""{name} AS (SELECT event_id, part_id, min(a) AS a, max(b) AS b FROM (SELECT *, sum(CASE WHEN a - m <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY event_id, part_id ORDER BY a, b, m NULLS FIRST ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT *, max(b) OVER (PARTITION BY event_id, part_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM {source})) GROUP BY event_id, part_id, g)"""


COVERED = f"""{RSEG}, {AMP}, sd AS (SELECT event_id, snap.part_id, greatest(0.0, station_m - w) AS a, least(length_m, station_m + w) AS b FROM (SELECT *, least(200.0, greatest(20.0, greatest(h, 0.2) * 60.0)) * 500.0 + 1000.0 AS w FROM snap WHERE h < 1.0) snap JOIN len ON len.part_id = snap.part_id),
{_islands('sm', 'sd', 2000.0)}, bs AS (SELECT event_id, x.part_id, greatest(0.0, a - 1000.0) AS a, least(length_m, b + 1000.0) AS b FROM (SELECT event_id, part_id, s0 AS a, s1 AS b FROM rseg UNION ALL SELECT * FROM sm) x JOIN len ON len.part_id = x.part_id),
{_islands('cv', 'bs', 1000.0)}, ed AS (SELECT event_id, part_id, a, b FROM cv UNION ALL SELECT DISTINCT event_id, part_id, 0.0, 0.0 FROM cv UNION ALL SELECT DISTINCT event_id, cv.part_id, length_m, length_m FROM cv JOIN len ON len.part_id = cv.part_id),
gp AS (SELECT * FROM (SELECT event_id, part_id, max(b) OVER w AS g0, lead(a) OVER w AS g1 FROM ed WINDOW w AS (PARTITION BY event_id, part_id ORDER BY a, b)) WHERE g1 > g0),
ct AS (SELECT gp.*, s FROM gp JOIN amp ON amp.event_id = gp.event_id AND amp.part_id = gp.part_id AND s > g0 + 1000.0 AND s < g1 - 1000.0 UNION ALL SELECT gp.*, g0 FROM gp),
br AS (SELECT event_id, part_id, g0, g1, count(*) AS pieces, max(coalesce(nx, g1) - s) AS longest_m FROM (SELECT *, lead(s) OVER (PARTITION BY event_id, part_id, g0 ORDER BY s) AS nx FROM ct) GROUP BY 1, 2, 3, 4),
bp AS (SELECT *, g1 - g0 <= 150000.0 OR (pieces > 1 AND longest_m <= 150000.0) AS passed FROM br)"""


def _covered(runup, coast):
    snapped = TS.events_snapped(runup, coast)
    return infill.coverage(_runup_segments(runup, coast), snapped.where("h < 1.0"), _lengths(coast))


@query(f"WITH {COVERED} SELECT event_id, part_id, round(g0, 3) AS g0, round(g1, 3) AS g1, pieces, round(longest_m, 3) AS longest_m, passed FROM bp", "fx_runup", "fx_coast_vertex")
def infill_coverage(runup, coast):
    found = infill.coverage_bridges(_covered(runup, coast), infill.amplifiers(_low(runup, coast)), _lengths(coast), 150_000.0)
    return _rounded(found, "event_id", "part_id", "g0", "g1", "pieces", "longest_m", "passed")


@query(f"WITH {COVERED}, pb AS (SELECT event_id, part_id, g0 AS a, g1 AS b FROM bp WHERE passed), {_islands('ps', 'pb', 1000.0)} SELECT event_id, part_id, round(a, 3) AS s0, round(b, 3) AS s1 FROM ps", "fx_runup", "fx_coast_vertex")
def infill_coverage_segments(runup, coast):
    found = infill.coverage_bridges(_covered(runup, coast), infill.amplifiers(_low(runup, coast)), _lengths(coast), 150_000.0)
    return _rounded(infill.coverage_segments(found), "event_id", "part_id", "s0", "s1")


#: The view's parts lie about 200 km apart, so ends meet within that much; a way over a meeting counts its parts only.
NETWORK = f"""{NODES}, pe AS (SELECT part_id, arg_min(node, "end") AS u, arg_max(node, "end") AS v FROM nodes GROUP BY 1), ed AS (SELECT u, v, min(length_m) AS cost FROM (SELECT u, v, length_m FROM pe JOIN len USING (part_id) UNION ALL SELECT v, u, length_m FROM pe JOIN len USING (part_id)) WHERE u <> v GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {NETWORK}, w(source, node, cost) USING KEY (source, node) AS (SELECT DISTINCT node, node, 0.0::DOUBLE FROM nodes
  UNION SELECT n.source, n.v, n.cost FROM (SELECT w.source, ed.v, min(w.cost + ed.cost) AS cost FROM w JOIN ed ON ed.u = w.node GROUP BY 1, 2) n LEFT JOIN recurring.w r ON r.source = n.source AND r.node = n.v WHERE n.cost <= 3000000.0 AND n.cost < coalesce(r.cost, 1e18))
SELECT CAST(source AS BIGINT) AS source, CAST(node AS BIGINT) AS node, round(cost, 3) AS cost_m FROM w""", "fx_coast_vertex")  # fmt: skip
def coast_distance(coast):
    segs = joins.segments(coast)
    nodes = network.stitched_nodes(segs, 200_000.0)
    edges = network.part_edges(nodes, _lengths(coast))
    return network.distances(edges, nodes.select(c("node").alias("source")), 3_000_000.0).select("source", "node", F.round("cost", 3).alias("cost_m"))


def _event_points(runup, coast):
    rows = TS.events_snapped(runup, coast).where("h >= 4.0")
    return rows.select("event_id", c("runup_id").alias("node"), "part_id", "station_m")


@query(f"""WITH RECURSIVE {NETWORK}, nr AS (SELECT runup_id, tsunami_event_id AS event_id, runup_ht AS h, part_id, s0 + t * len AS pos, sqrt(pow(x_m - x1 - t * (x2 - x1), 2) + pow(y_m - y1 - t * (y2 - y1), 2)) AS d
  FROM (SELECT *, greatest(0.0, least(1.0, ((x_m - x1) * (x2 - x1) + (y_m - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t FROM fx_runup, seg)),
pt AS (SELECT event_id, runup_id AS node, part_id, pos FROM (SELECT * FROM nr WHERE d <= 25000 QUALIFY row_number() OVER (PARTITION BY runup_id ORDER BY d, part_id, pos) = 1) WHERE h >= 4.0),
st AS (SELECT event_id, part_id, node, pos, 1 AS side FROM pt UNION ALL SELECT DISTINCT event_id, pt.part_id, -1 - n.node, CASE WHEN n."end" = 0 THEN 0.0 ELSE length_m END, n."end" * 2 FROM pt JOIN nodes n ON n.part_id = pt.part_id JOIN len ON len.part_id = pt.part_id),
se AS (SELECT event_id, node AS u, lead(node) OVER w AS v, lead(pos) OVER w - pos AS cost FROM st WINDOW w AS (PARTITION BY event_id, part_id ORDER BY pos, side, node)),
ee AS (SELECT event_id, u, v, min(cost) AS cost FROM (SELECT * FROM se WHERE v IS NOT NULL UNION ALL SELECT event_id, v, u, cost FROM se WHERE v IS NOT NULL UNION ALL SELECT event_id, -1 - u, -1 - v, cost FROM ed, (SELECT DISTINCT event_id FROM pt)) GROUP BY 1, 2, 3),
w(event_id, source, node, cost) USING KEY (event_id, source, node) AS (SELECT event_id, node, node, 0.0::DOUBLE FROM pt
  UNION SELECT n.event_id, n.source, n.v, n.cost FROM (SELECT w.event_id, w.source, ee.v, min(w.cost + ee.cost) AS cost FROM w JOIN ee ON ee.event_id = w.event_id AND ee.u = w.node GROUP BY 1, 2, 3) n LEFT JOIN recurring.w r ON r.event_id = n.event_id AND r.source = n.source AND r.node = n.v WHERE n.cost <= 1000000.0 AND n.cost < coalesce(r.cost, 1e18))
SELECT event_id, source, node, round(cost, 3) AS cost_m FROM w WHERE node >= 0""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def station_distance(runup, coast):
    """Along the coast between the high run-ups of an event, at most 1000 km."""
    segs, points = joins.segments(coast), _event_points(runup, coast)
    found = network.station_distances(points, points.select("event_id", c("node").alias("source")), network.stitched_nodes(segs, 200_000.0), _lengths(coast), 1_000_000.0)
    return found.select("event_id", "source", "node", F.round("cost", 3).alias("cost_m"))


@query(None, "fx_runup", "fx_coast_vertex")
def infill_cross_part(runup, coast):
    found = infill.cross_part_bridges(_runup_segments(runup, coast), joins.segments(coast), 400_000.0, 210_000.0)
    return _rounded(found, "event_id", "part_a", "station_a", "part_b", "station_b", "length_m")


@query(None, "fx_runup", "fx_coast_vertex")
def infill_chain(runup, coast):
    """Chains between segments on different parts over low run-ups, wherever they lie."""
    found = infill.infill_chain(_runup_segments(runup, coast), joins.segments(coast), _low(runup, coast), 300_000.0, 500_000.0, snap_m=210_000.0)
    return found.select("event_id", "pass", "part_start", F.round("station_start", 3).alias("station_start"), "part_end", F.round("station_end", 3).alias("station_end"), "hops", F.round("length_m", 3).alias("length_m"))
