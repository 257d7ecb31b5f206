"""DuckDB oracle SQL per registered query (see ``oracle.py`` for the CTEs)."""

from __future__ import annotations

from collidex.config import DEFAULT_CUTS, EVENT_FEATURES, PARTICLE_FEATURES, TIGHT_CUTS
from collidex.plans.oracle import FIXTURE, feature_ctes, r3, r6, rounded, with_, wrap_sql

ORACLE: dict[str, str] = {}
P = feature_ctes(DEFAULT_CUTS)

ORACLE["events_scan"] = with_(FIXTURE, f"""
SELECT event_id, label, electron_size AS Electron_size, muon_size AS MuonTight_size,
  CAST((SELECT count(*) FROM fx_particles p WHERE p.event_id = e.event_id AND species = 'track') AS INTEGER) AS n_tracks,
  CAST((SELECT count(*) FROM fx_particles p WHERE p.event_id = e.event_id AND species = 'photon') AS INTEGER) AS n_photons,
  CAST((SELECT count(*) FROM fx_particles p WHERE p.event_id = e.event_id AND species = 'neutral') AS INTEGER) AS n_neutrals,
  CAST((SELECT count(*) FROM fx_particles p WHERE p.event_id = e.event_id AND species = 'jet') AS INTEGER) AS n_jets,
  {r6('met')} AS met, {r6('met_phi')} AS met_phi
FROM fx_events e""")

ORACLE["particles"] = with_(FIXTURE, f"""
SELECT event_id, species,
  CAST(row_number() OVER (PARTITION BY event_id, species ORDER BY pos) - 1 AS INTEGER) AS pos,
  {r6('pt')} AS pt, {r6('eta')} AS eta, CASE WHEN species <> 'jet' THEN {r6('phi')} END AS phi,
  CASE WHEN species = 'track' THEN {r6('x')} END AS x,
  CASE WHEN species = 'track' THEN {r6('y')} END AS y,
  CASE WHEN species = 'track' THEN {r6('z')} END AS z,
  CASE WHEN species = 'track' THEN pid END AS pid,
  CASE WHEN species IN ('electron', 'muon') THEN charge END AS charge,
  CASE WHEN species = 'jet' THEN btag END AS btag
FROM fx_particles""")

ORACLE["union_samples"] = with_(FIXTURE, """
SELECT e.event_id, e.label,
  CAST(count(p.event_id) AS INTEGER) AS n_tracks
FROM fx_events e LEFT JOIN fx_particles p ON p.event_id = e.event_id AND p.species = 'track'
GROUP BY e.event_id, e.label""")

ORACLE["sample_stats"] = with_(FIXTURE, """
SELECT count(*) FILTER (WHERE label = 0) AS qcd, count(*) FILTER (WHERE label = 1) AS ttbar,
       count(*) FILTER (WHERE label = 2) AS wjets
FROM fx_events""")

ORACLE["events_preview"] = with_(FIXTURE, f"""
SELECT event_id, label, electron_size, muon_size, {r6('met')} AS met, {r6('met_phi')} AS met_phi
FROM fx_events ORDER BY event_id LIMIT 10""")

_KIN = FIXTURE + """,
k0 AS (SELECT event_id, species, pos, x, abs(pt) * cos(phi) AS px, abs(pt) * sin(phi) AS py,
              abs(pt) * sinh(eta) AS pz FROM fx_particles),
k1 AS (SELECT *, sqrt(px * px + py * py + pz * pz) AS mag FROM k0),
k2 AS (SELECT *, CASE WHEN mag = 0 THEN 1e0 ELSE pz / mag END AS ct FROM k1)"""
ORACLE["kinematics"] = with_(_KIN, f"""
SELECT event_id, species, pos, {r6('px')} AS px, {r6('py')} AS py, {r6('pz')} AS pz,
  {r6('sqrt(px * px + py * py + pz * pz + 0e0 * 0e0)')} AS e,
  {r6('sqrt(px * px + py * py + pz * pz + x * x)')} AS e_massive,
  {r6('CASE WHEN -x * 10e0 >= 0 THEN sqrt(px * px + py * py + pz * pz + (-x * 10e0) * (-x * 10e0)) ELSE sqrt(greatest(px * px + py * py + pz * pz - (-x * 10e0) * (-x * 10e0), 0e0)) END')} AS e_negative,
  {r6('sqrt(px * px + py * py)')} AS p_pt, {r6('mag')} AS p_mag, {r6('ct')} AS cos_theta,
  {r6('CASE WHEN ct * ct < 1 THEN -0.5e0 * ln((1e0 - ct) / (1e0 + ct)) WHEN pz = 0 THEN 0e0 END')} AS p_eta,
  {r6('atan2(py, px)')} AS p_phi
FROM k2""")

_dphi = "(p.phi - e.met_phi * 2e0)"
ORACLE["delta_r"] = with_(FIXTURE, f"""
SELECT event_id, species, pos, {r6(wrap_sql('dphi0'))} AS dphi,
  {r6('sqrt((eta - 0e0) * (eta - 0e0) + ' + wrap_sql('dphi0') + ' * ' + wrap_sql('dphi0') + ')')} AS dr
FROM (SELECT p.event_id, p.species, p.pos, p.eta, {_dphi} AS dphi0
      FROM fx_particles p JOIN fx_events e USING (event_id))""")

ORACLE["pt_map"] = with_(P, f"""
SELECT event_id, species, pos, {r6('pt')} AS pt, {r6('eta')} AS eta, {r6('phi')} AS phi FROM maps""")

ORACLE["preselect"] = with_(P, "SELECT event_id, label, electron_size, muon_size FROM pre")

ORACLE["isolation"] = with_(P, f"""
SELECT event_id, species, pos, {r6('iso_ch')} AS iso_ch, {r6('iso_gamma')} AS iso_gamma,
       {r6('iso_neu')} AS iso_neu FROM iso""")

ORACLE["isolation_dense"] = ORACLE["isolation"]

ORACLE["lepton_first"] = with_(P, "SELECT event_id, species, pos FROM lep_first")

ORACLE["lepton_select"] = with_(P, f"""
SELECT event_id, lep_species, {r6('lep_pt')} AS lep_pt, {r6('lep_eta')} AS lep_eta,
       {r6('lep_charge')} AS lep_charge FROM sel""")

ORACLE["track_overlap"] = with_(P, """
SELECT s.event_id,
  CAST((SELECT count(*) FROM obj o WHERE o.event_id = s.event_id AND o.species = 'track') AS BIGINT) AS n_kept,
  CAST((SELECT count(*) FROM iso i WHERE i.event_id = s.event_id AND i.species = 'track')
     - (SELECT count(*) FROM obj o WHERE o.event_id = s.event_id AND o.species = 'track') AS BIGINT) AS n_removed
FROM sel s
WHERE EXISTS (SELECT 1 FROM iso i WHERE i.event_id = s.event_id AND i.species = 'track')""")

ORACLE["jets_ht"] = with_(P, f"SELECT event_id, {r6('nJets')} AS nJets, {r6('HT')} AS HT, {r6('nBjets')} AS nBjets FROM jets")

_EF = ", ".join([r6(c) + f" AS {c}" for c in EVENT_FEATURES])
ORACLE["event_features"] = with_(P, f"SELECT event_id, {_EF}, label FROM ef")
ORACLE["event_features_tight"] = with_(feature_ctes(TIGHT_CUTS), f"SELECT event_id, {_EF}, label FROM ef")
_PF = rounded(list(PARTICLE_FEATURES))
ORACLE["particle_features"] = with_(P, f"SELECT event_id, CAST(seq AS INTEGER) AS seq, species, {_PF} FROM pf")
ORACLE["particle_caps"] = with_(
    feature_ctes(DEFAULT_CUTS.with_(max_tracks=5, max_photons=3, max_neutrals=3)),
    f"SELECT event_id, CAST(seq AS INTEGER) AS seq, species, {rounded(['Pt', 'Eta', 'Phi', 'ChPFIso'])} FROM pf")

# -------------------------------------------------------------- sequences ---
_FC = list(PARTICLE_FEATURES)
_MATRIX = feature_ctes(DEFAULT_CUTS.with_(max_tracks=450, max_photons=150, max_neutrals=200))
ORACLE["lfeatures"] = with_(_MATRIX, f"SELECT event_id, CAST(seq AS INTEGER) AS row, {_PF} FROM pf")
ORACLE["lfeatures_size"] = with_(_MATRIX, f"""
SELECT event_id, CAST(greatest(count(*), {DEFAULT_CUTS.n_rows}) AS INTEGER) AS n_rows,
       CAST(19 AS INTEGER) AS n_cols, CAST(count(*) AS INTEGER) AS n_real
FROM pf GROUP BY event_id""")

_SEQ = P + f""",
sq0 AS (
  SELECT p.*, l.Eta AS lep_eta, l.Phi AS lep_phi
  FROM pf p JOIN (SELECT event_id, Eta, Phi FROM pf WHERE seq = 0) l USING (event_id)),
sq1 AS (
  SELECT *, sqrt((lep_eta - Eta) * (lep_eta - Eta)
                 + {wrap_sql('lep_phi - Phi')} * {wrap_sql('lep_phi - Phi')}) AS dr FROM sq0),
sq AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY dr DESC, seq ASC) - 1 AS INTEGER) AS idx
  FROM sq1),
sc AS (
  SELECT event_id, idx,
    {", ".join(f"({c} - avg({c}) OVER w) / (CASE WHEN stddev_pop({c}) OVER w < 1e-12 THEN 1e0 ELSE stddev_pop({c}) OVER w END) AS {c}" for c in _FC)}
  FROM sq WINDOW w AS (PARTITION BY event_id))"""
ORACLE["sequence_order"] = with_(_SEQ, f"SELECT event_id, CAST(seq AS INTEGER) AS seq, idx, {r6('dr')} AS dr FROM sq")
ORACLE["sequence_scaled"] = with_(_SEQ, f"SELECT event_id, idx, {rounded(_FC)} FROM sc")
_EFC = list(EVENT_FEATURES)
ORACLE["inclusive_features"] = with_(_SEQ + f""",
pool AS (
  SELECT event_id, CAST(count(*) AS INTEGER) AS seq_len,
    {", ".join(f"max({c}) AS max_{c}" for c in _FC)}, {", ".join(f"min({c}) AS min_{c}" for c in _FC)}
  FROM sc GROUP BY event_id),
mm AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _EFC)} FROM ef)""", f"""
SELECT p.event_id, p.seq_len,
  {", ".join(f"{r6('p.max_' + c)} AS max_{c}, {r6('p.min_' + c)} AS min_{c}" for c in _FC)},
  {", ".join(r6(f"CASE WHEN mm.hi_{c} = mm.lo_{c} THEN 0.5e0 ELSE (e.{c} - mm.lo_{c}) * (1e0 / (mm.hi_{c} - mm.lo_{c})) END") + f" AS {c}" for c in _EFC)},
  e.label
FROM pool p JOIN ef e USING (event_id), mm""")

# ------------------------------------------------------------- evaluation ---
_CLS = "(SELECT CAST(unnest(range(10)) AS INTEGER) AS c)"
_SCORES = f"""emb_long AS (
  SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS j FROM embeddings),
emb_scores AS (
  SELECT e.vec_id, e.label, m.model, cls.c AS class,
         CAST(sum(CAST(floor(CAST(e.v AS DOUBLE) * 1048576) AS BIGINT) * (((e.j + m.shift) * (2 * cls.c + 3)) % 11 - 5)) AS DOUBLE) / 1048576 AS score
  FROM emb_long e, {_CLS} cls, (VALUES ('baseline', 0), ('grid', 1), ('random', 2)) m(model, shift)
  GROUP BY e.vec_id, e.label, m.model, cls.c)"""
_PRED = _SCORES + """,
emb_pred AS (
  SELECT vec_id, label AS y_true, CAST(arg_min(class, (-score, class)) AS INTEGER) AS y_pred
  FROM emb_scores WHERE model = 'baseline' GROUP BY vec_id, label)"""
ORACLE["label_counts"] = with_(FIXTURE, "SELECT label, count(*) AS count FROM fx_events GROUP BY label")
ORACLE["class_counts"] = with_(_PRED, "SELECT y_pred, count(*) AS count FROM emb_pred GROUP BY y_pred")
ORACLE["confusion_matrix"] = with_(_PRED, f"""
SELECT l.c AS y_true, {", ".join(f"count(p.vec_id) FILTER (WHERE p.y_pred = {k}) AS pred_{k}" for k in range(10))},
       count(p.vec_id) FILTER (WHERE p.y_pred IS NULL OR p.y_pred NOT BETWEEN 0 AND 9) AS pred_other
FROM (SELECT c FROM {_CLS} UNION ALL SELECT NULL) l
LEFT JOIN emb_pred p ON l.c IS NOT DISTINCT FROM CASE WHEN p.y_true BETWEEN 0 AND 9 THEN p.y_true END
GROUP BY l.c""")
ORACLE["accuracy"] = with_(_PRED, f"""
SELECT {r6('avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END)')} AS accuracy, count(*) AS n FROM emb_pred""")

_LONG = _SCORES + """,
long AS (
  SELECT class, score, CASE WHEN label = class THEN 1 ELSE 0 END AS is_pos FROM emb_scores WHERE model = 'baseline'),
pts AS (
  SELECT class, score, CAST(sum(is_pos) AS BIGINT) AS pos, CAST(sum(1 - is_pos) AS BIGINT) AS neg
  FROM long GROUP BY class, score)"""
ORACLE["roc_curve"] = with_(_LONG + """,
tot AS (SELECT class, sum(pos) AS P, sum(neg) AS N FROM pts GROUP BY class),
cur AS (
  SELECT class, score AS threshold,
         CAST(sum(pos) OVER (PARTITION BY class ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (PARTITION BY class ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
  FROM pts
  UNION ALL SELECT class, 'inf'::DOUBLE, 0, 0 FROM tot)""", f"""
SELECT c.class, c.threshold, c.tp, c.fp,
       CASE WHEN t.P > 0 THEN {r6('c.tp / t.P')} END AS tpr, CASE WHEN t.N > 0 THEN {r6('c.fp / t.N')} END AS fpr
FROM cur c JOIN tot t USING (class)""")


ORACLE["roc_curve_binned"] = with_(_LONG, "SELECT class, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, true AS within_bound, true AS bounded FROM pts GROUP BY class")


def _auc_sql(long_cte: str, keys: str) -> str:
    return long_cte + f""",
ac AS (
  SELECT *, coalesce(sum(pos) OVER (PARTITION BY {keys} ORDER BY score DESC
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_pos
  FROM pts),
auc AS (
  SELECT {keys}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                      THEN sum(neg * (cum_pos + pos / 2e0)) / (sum(pos) * sum(neg)) END AS auc
  FROM ac GROUP BY {keys})"""


ORACLE["auc"] = with_(_auc_sql(_LONG, "class"), f"SELECT class, {r6('auc')} AS auc FROM auc")
_LONG_M = _SCORES + """,
long AS (
  SELECT model, class, score, CASE WHEN label = class THEN 1 ELSE 0 END AS is_pos FROM emb_scores),
pts AS (
  SELECT model, class, score, CAST(sum(is_pos) AS BIGINT) AS pos, CAST(sum(1 - is_pos) AS BIGINT) AS neg
  FROM long GROUP BY model, class, score)"""
ORACLE["model_compare"] = with_(_auc_sql(_LONG_M, "model, class"), f"""
SELECT model, class, {r6('auc')} AS auc,
       row_number() OVER (PARTITION BY class ORDER BY auc DESC, model) = 1 AS is_best
FROM auc""")

_HIST = """hist AS (
  SELECT event_type AS trainer, CAST(user_id % 5 AS INTEGER) AS worker_id, value AS loss,
         row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY event_id) AS iteration
  FROM events)"""
ORACLE["worker_iterations"] = with_(_HIST, "SELECT trainer, worker_id, count(*) AS iterations FROM hist GROUP BY trainer, worker_id")
ORACLE["loss_curve"] = with_(_HIST + """,
per_i AS (SELECT trainer, iteration - 1 AS i, avg(loss) AS m, stddev_pop(loss) AS s
          FROM hist GROUP BY trainer, iteration - 1)""", f"""
SELECT trainer, CAST(max(i) AS BIGINT) AS iteration, {r6('avg(m)')} AS loss, {r6('avg(s)')} AS error
FROM per_i GROUP BY trainer, ceil(i / 100e0)""")
ORACLE["loss_smooth"] = with_("""ser AS (
  SELECT event_type AS trainer, value AS loss, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS it
  FROM events),
grp AS (SELECT trainer, greatest(ceil(it / 100e0), 1) AS g, max(it) AS iteration, sum(loss) AS s
        FROM ser GROUP BY trainer, greatest(ceil(it / 100e0), 1))""", f"""
SELECT trainer, CAST(iteration AS BIGINT) AS iteration, {r6('s / 100e0')} AS avg_loss FROM grp WHERE iteration = g * 100""")

# ------------------------------------------------------------ preparation ---
_MIX = "(((event_id % 2147483648) * 2654435761) % 4294967296)"
_SPLIT = f"CASE WHEN {_MIX} < 858993459 THEN 'test' ELSE 'train' END"
ORACLE["one_hot"] = with_(FIXTURE, "SELECT event_id, label, " + ", ".join(
    f"CASE WHEN label = {k} THEN 1e0 ELSE 0e0 END AS oh_{k}" for k in range(3)) + " FROM fx_events")
ORACLE["split_counts"] = with_(FIXTURE, f"SELECT {_SPLIT} AS split, label, count(*) AS count FROM fx_events GROUP BY 1, 2")
ORACLE["undersample"] = with_(FIXTURE, f"""
SELECT event_id, label FROM (
  SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {_MIX}) AS rk FROM fx_events)
WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM fx_events GROUP BY label))""")
ORACLE["min_max"] = with_(P + f""",
efs AS (SELECT *, {_SPLIT} AS split FROM ef),
lim AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _EFC)} FROM efs WHERE split = 'train')""", f"""
SELECT event_id, split, {", ".join(r6(f"CASE WHEN hi_{c} = lo_{c} THEN 0.5e0 ELSE (e.{c} - lo_{c}) * (1e0 / (hi_{c} - lo_{c})) + 0e0 END") + f" AS f{i}" for i, c in enumerate(_EFC))}
FROM efs e, lim""")
ORACLE["vector_columns"] = with_(P, "SELECT event_id, label, " + ", ".join(
    f"{r6(c)} AS f{i}" for i, c in enumerate(_EFC)) + " FROM ef")

# ----------------------------------------------------------------- models ---
# The searched values: the grid's, and the draws of seed 42.
_SPACES = {
    "grid": {"batch": [100, 200, 400], "epochs": [30, 50, 80], "nh1": [50, 100, 150], "nh2": [20, 50, 100], "nh3": [10, 20, 50]},
    "random": {"batch": [359, 89], "epochs": [23, 55, 51, 48], "nh1": [45, 198, 36, 183], "nh2": [79, 21, 85, 64], "nh3": [12, 11, 15]}}


def _space(kind: str) -> str:
    """All combinations of one search, numbered with the last axis running fastest."""
    axes = _SPACES[kind]
    number = "0"
    for c, v in axes.items():
        number = f"({number} * {len(v)} + i_{c})"
    return f"SELECT '{kind}' AS search, CAST({number} AS INTEGER) AS combination, " + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in axes) + (
        " FROM " + ", ".join(f"(SELECT unnest({v}) AS {c}, unnest(range({len(v)})) AS i_{c})" for c, v in axes.items()))


_TRAIN = P + f""",
train AS (SELECT event_id, CAST({_MIX} % 3 AS INTEGER) AS fold FROM ef WHERE {_SPLIT} = 'train')"""
ORACLE["search_space"] = with_(_TRAIN, f"""
SELECT s.*, CAST(f.fold AS INTEGER) AS fold, (SELECT count(*) FROM train t WHERE t.fold = f.fold) AS tested
FROM ({_space('grid')} UNION ALL {_space('random')}) s, (SELECT unnest(range(3)) AS fold) f""")
# one worker (up to 50,000 events), 50 epochs in batches of 128
ORACLE["training_history"] = with_(_TRAIN, """
SELECT trainer, CAST(0 AS INTEGER) AS worker_id, CAST(50 * ceil(n / 128e0) AS BIGINT) AS iterations
FROM (SELECT 'without_fold_' || f.fold AS trainer, count(*) AS n FROM train t, (SELECT unnest(range(3)) AS fold) f WHERE t.fold <> f.fold GROUP BY 1
      UNION ALL SELECT 'all_rows', count(*) FROM train)""")

# ----------------------------------------------------------------- images ---
import math  # noqa: E402

from collidex.functions.kinematics import grid_shape  # noqa: E402
from collidex.plans.oracle import d  # noqa: E402

_RES = 100
_NETA, _NPHI, _EETA, _EPHI = grid_shape(_RES, 5.0)
_PTS = P + f""",
pts0 AS (
  SELECT event_id, seq AS pos, Eta AS eta, Phi AS phi,
         least(ln(greatest(Pt, 1.001e0)) / 5e0, 10e0) AS size,
         CAST(list_position([isChHad, isNeuHad, isGamma, isEle, isMu, Charge],
                            list_max([isChHad, isNeuHad, isGamma, isEle, isMu, Charge])) - 1 AS INTEGER) AS ptype
  FROM pf
  UNION ALL
  SELECT event_id, {DEFAULT_CUTS.n_rows} AS pos, 0e0 AS eta, phiMET AS phi,
         CASE WHEN MET > 0 THEN least(greatest(ln(MET) / 5e0, 0.001e0), 10e0) ELSE 0.001e0 END AS size,
         5 AS ptype
  FROM ef),
pts AS (SELECT * FROM pts0 WHERE NOT (eta = 0 AND phi = 0))"""
ORACLE["image_points"] = with_(_PTS, f"""
SELECT event_id, pos, {r6('eta')} AS eta, {r6('phi')} AS phi, {r6('size')} AS size, ptype FROM pts""")

_TP = repr(2 * math.pi)


def _e(i, j):
    """Where the edge from vertex i to vertex j crosses row x."""
    return (f"CASE WHEN (vx{i} <= x AND x < vx{j}) OR (vx{j} <= x AND x < vx{i}) THEN "
            f"(vy{j} - vy{i}) * (x - vx{i}) / (CASE WHEN vx{j} - vx{i} = 0 THEN NULL ELSE vx{j} - vx{i} END) + vy{i} END")


_cross = "CASE nv " + " ".join(f"WHEN {n} THEN [" + ", ".join(_e(i, (i - 1) % n) for i in range(n)) + "]" for n in (3, 4, 5)) + " END"
_vert = ", ".join(
    f"CASE WHEN nv > {k} THEN cx + R * cos({d(k)} * ({_TP} / nv)) END AS vx{k}, "
    f"CASE WHEN nv > {k} THEN cy + R * sin({d(k)} * ({_TP} / nv)) END AS vy{k}" for k in range(5))
_COV = _PTS + f""",
pc0 AS (
  SELECT event_id, pos, ptype,
         CASE ptype WHEN 0 THEN 4 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 5 WHEN 4 THEN 5 ELSE 0 END AS nv,
         (eta + 5e0) / {d(_EETA)} AS cx, size * {d(_RES / 1.5)} AS R, ((phi + o.off) + {repr(math.pi)}) / {repr(_EPHI)} AS cy
  FROM pts, (VALUES (0e0), ({_TP}), (-{_TP})) o(off)),
pc1 AS (SELECT *, {_vert} FROM pc0),
pc2 AS (
  SELECT *,
    CASE WHEN nv = 0 THEN greatest(ceil(cx - R), 0) ELSE greatest(floor(least(vx0, vx1, vx2, vx3, vx4)), 0) END AS x0,
    CASE WHEN nv = 0 THEN least(floor(cx + R), {_NETA - 1}) ELSE least(ceil(greatest(vx0, vx1, vx2, vx3, vx4)), {_NETA - 1}) END AS x1,
    CASE WHEN nv = 0 THEN greatest(ceil(cy - R), 0) ELSE greatest(floor(least(vy0, vy1, vy2, vy3, vy4)), 0) END AS y0,
    CASE WHEN nv = 0 THEN least(floor(cy + R), {_NPHI - 1}) ELSE least(ceil(greatest(vy0, vy1, vy2, vy3, vy4)), {_NPHI - 1}) END AS y1
  FROM pc1),
lin AS (SELECT pc2.*, CAST(gx.x AS DOUBLE) AS x FROM pc2, generate_series(CAST(x0 AS BIGINT), CAST(x1 AS BIGINT)) gx(x) WHERE x0 <= x1 AND y0 <= y1),
-- discs by the test of every pixel of the row; polygons by the two crossings
cols AS (
  SELECT event_id, pos, ptype, x, list_filter(generate_series(CAST(y0 AS BIGINT), CAST(y1 AS BIGINT)),
         lambda y: (((x - x0) - (cx - x0)) / R) * (((x - x0) - (cx - x0)) / R) + (((y - y0) - (cy - y0)) / R) * (((y - y0) - (cy - y0)) / R) < 1) AS ys
  FROM lin WHERE nv = 0),
spans0 AS (
  SELECT event_id, pos, ptype, CAST(x AS INTEGER) AS x, list_min(ys) AS a, list_max(ys) AS b FROM cols WHERE len(ys) > 0
  UNION ALL
  SELECT event_id, pos, ptype, CAST(x AS INTEGER), greatest(CAST(ceil(list_min(c)) AS BIGINT), CAST(y0 AS BIGINT)), least(CAST(ceil(list_max(c)) AS BIGINT) - 1, CAST(y1 AS BIGINT))
  FROM (SELECT *, {_cross} AS c FROM lin WHERE nv > 0) WHERE list_min(c) IS NOT NULL),
spans AS MATERIALIZED (
  -- a copy's columns behind those of the copies before it
  SELECT event_id, pos, ptype, x, greatest(a, coalesce(max(b) OVER (PARTITION BY event_id, pos, x ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, a)) AS a, b
  FROM spans0 WHERE a <= b),
cuts AS (SELECT DISTINCT event_id, x, c FROM (SELECT event_id, x, a AS c FROM spans WHERE a <= b UNION ALL SELECT event_id, x, b + 1 FROM spans WHERE a <= b)),
segs AS (SELECT event_id, x, c AS y0, lead(c) OVER (PARTITION BY event_id, x ORDER BY c) - 1 AS y1 FROM cuts),
held AS (
  SELECT s.event_id, s.x, s.y0, s.y1, p.ptype, row_number() OVER (PARTITION BY s.event_id, s.x, s.y0 ORDER BY p.pos DESC) - 1 AS j
  FROM segs s JOIN spans p ON p.event_id = s.event_id AND p.x = s.x AND p.a <= s.y0 AND p.b >= s.y1 WHERE s.y1 IS NOT NULL),
bl AS MATERIALIZED (
  SELECT event_id, x, y0, y1,
         pow(0.7e0, count(*)) + sum(0.3e0 * pow(0.7e0, j) * cr) AS r,
         pow(0.7e0, count(*)) + sum(0.3e0 * pow(0.7e0, j) * cg) AS g,
         pow(0.7e0, count(*)) + sum(0.3e0 * pow(0.7e0, j) * cb) AS b
  FROM (SELECT *, CASE WHEN ptype IN (0, 1) THEN 1e0 ELSE 0e0 END AS cr,
               CASE WHEN ptype = 1 THEN 1e0 WHEN ptype IN (3, 4) THEN {repr(128 / 255)} ELSE 0e0 END AS cg,
               CASE WHEN ptype = 2 THEN 1e0 ELSE 0e0 END AS cb
        FROM held)
  GROUP BY event_id, x, y0, y1)"""
ORACLE["image_pixels"] = with_(_COV, "SELECT event_id, ptype, CAST(sum(b - a + 1) AS BIGINT) AS n_hits FROM spans WHERE a <= b GROUP BY event_id, ptype")
ORACLE["image_blend"] = with_(_COV, f"""
SELECT event_id, CAST(sum(y1 - y0 + 1) AS BIGINT) AS n_pixels, {r3('sum(r * (y1 - y0 + 1))')} AS sum_r, {r3('sum(g * (y1 - y0 + 1))')} AS sum_g,
       {r3('sum(b * (y1 - y0 + 1))')} AS sum_b, {r6('min(r)')} AS min_r
FROM bl GROUP BY event_id""")
ORACLE["image_dense"] = with_(_COV, f"""
SELECT e.event_id, e.label, {_NETA} AS n_eta, {_NPHI} AS n_phi,
       {r6(f"({_NETA * _NPHI * 3}e0 + coalesce(sum((r + g + b - 3e0) * (y1 - y0 + 1)), 0)) / {_NETA * _NPHI * 3}e0")} AS mean_value
FROM ef e LEFT JOIN bl USING (event_id) GROUP BY e.event_id, e.label""")
_byte = "lpad(to_hex(CAST(greatest(least(floor({c} * 255 + 0.5000001e0), 255), 0) AS INTEGER)), 2, '0')"
ORACLE["image_struct"] = with_(_COV + f""",
filled AS (
  SELECT event_id, x, y0, y1, {' || '.join(_byte.format(c=c) for c in 'bgr')} AS colour,
         coalesce(lag(y1) OVER w, -1) AS before, lead(y0) OVER w IS NULL AS last
  FROM bl WINDOW w AS (PARTITION BY event_id, x ORDER BY y0)),
lined AS (
  SELECT event_id, x, string_agg(repeat('FFFFFF', y0 - before - 1) || repeat(colour, y1 - y0 + 1)
                                 || CASE WHEN last THEN repeat('FFFFFF', {_NPHI - 1} - y1) ELSE '' END, '' ORDER BY y0) AS digits
  FROM filled GROUP BY event_id, x),
every AS (SELECT event_id, x, coalesce(digits, repeat('FFFFFF', {_NPHI})) AS digits
          FROM (SELECT event_id, unnest(range({_NETA})) AS x FROM ef) LEFT JOIN lined USING (event_id, x))""", f"""
SELECT event_id, {_NETA} AS height, {_NPHI} AS width, 3 AS n_channels, {_NETA * _NPHI * 3} AS n_bytes,
       sha256(unhex(string_agg(digits, '' ORDER BY x))) AS data_sha256
FROM every GROUP BY event_id""")

# ------------------------------------------------- skew-safe formulations ---
ORACLE["particle_features_skew_safe"] = ORACLE["particle_features"]
ORACLE["sequence_scaled_skew_safe"] = ORACLE["sequence_scaled"]
ORACLE["fixed_subset"] = with_(FIXTURE, f"""
SELECT event_id, label FROM (SELECT event_id, label, row_number() OVER (ORDER BY {_MIX}) AS rk FROM fx_events)
WHERE rk <= 500""")

# -------------------------------------------------------- jobs and sinks ---
ORACLE["shuffle"] = with_(FIXTURE, "SELECT event_id, label FROM fx_events")
ORACLE["job_event_features"] = ORACLE["event_features"]
ORACLE["job_particle_features"] = ORACLE["particle_features"]
ORACLE["job_sequences"] = ORACLE["sequence_scaled"]
ORACLE["events_preselected"] = with_(P, f"""
SELECT event_id, label FROM pre
WHERE event_id IN (SELECT event_id FROM fx_particles WHERE species IN ('electron', 'muon') AND pt > {d(DEFAULT_CUTS.lep_pt)})""")
ORACLE["events_renamed"] = with_(FIXTURE, """
SELECT event_id AS id, electron_size AS n_ele, muon_size AS n_mu,
       (SELECT count(*) FROM fx_particles p WHERE p.event_id = e.event_id AND species = 'jet') AS n_jet FROM fx_events e""")
ORACLE["prepared_round_trip"] = with_(P, "SELECT event_id, label, " + ", ".join(f"{r6(c)} AS f{i}" for i, c in enumerate(_EFC))
                                      + ", " + ", ".join(f"CASE WHEN label = {k} THEN 1e0 ELSE 0e0 END AS oh_{k}" for k in range(3)) + " FROM ef")
ORACLE["bucketed_join"] = with_(P, f"""
SELECT ef.event_id, ef.label, {r6('ef.HT')} AS HT, count(*) AS n_particles, {r6('max(pf.Pt)')} AS max_pt
FROM ef JOIN pf USING (event_id) GROUP BY ef.event_id, ef.label, ef.HT""")
