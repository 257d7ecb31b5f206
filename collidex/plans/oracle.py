"""Reference SQL for the registered queries, runnable by DuckDB on the driver
tables. It restates each operator's semantics independently of the Spark
code: windows, plain joins and aggregates over the lineitem-derived fixture.

Float outputs pass through ``r6`` (floor(x*1e6 + 0.5234567)/1e6 + 0.0) on both
sides, so results agree bit for bit despite summation order.
"""

from __future__ import annotations

from collidex.config import DEFAULT_CUTS, Cuts


def r6(expr: str) -> str:
    return f"(floor(({expr}) * 1e6 + 0.5234567e0) / 1e6 + 0e0)"


def r3(expr: str) -> str:
    return f"(floor(({expr}) * 1e3 + 0.5234567e0) / 1e3 + 0e0)"


def d(x: float) -> str:
    """A double literal."""
    return repr(float(x)) + "e0" if "e" not in repr(float(x)) else repr(float(x))


FIXTURE = """
fx_li AS (
  SELECT CAST(floor(l_orderkey / 10) AS BIGINT) AS event_id, l_orderkey, l_partkey, l_suppkey,
         l_linenumber, l_extendedprice, l_quantity, l_tax, l_discount, l_returnflag, l_linestatus,
         (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 20 AS code
  FROM lineitem),
fx_base AS (
  SELECT event_id,
    CASE WHEN code < 8 THEN 'track' WHEN code < 12 THEN 'photon' WHEN code < 16 THEN 'neutral'
         WHEN code < 18 THEN 'electron' WHEN code = 18 THEN 'muon' ELSE 'jet' END AS species,
    CAST(row_number() OVER (PARTITION BY event_id
         ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS pos,
    l_extendedprice / CASE WHEN code < 8 THEN 10000e0 WHEN code < 16 THEN 4000e0
                           WHEN code < 19 THEN 2000e0 ELSE 1000e0 END AS pt,
    CASE WHEN code = 19
         THEN ((l_partkey * 37 + l_orderkey * 11 + l_linenumber * 53) % 481 - 240) * 0.0101e0 * 1.25e0
         ELSE ((l_partkey * 37 + l_orderkey * 11 + l_linenumber * 53) % 481 - 240) * 0.0101e0 END AS eta,
    ((l_suppkey * 41 + l_orderkey * 29 + l_linenumber * 97) % 629 - 314) * 0.0097e0 AS phi,
    l_quantity / 10e0 AS x, l_tax * 100e0 AS y, l_discount * 100e0 AS z,
    CAST(CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 0
              WHEN l_linestatus = 'O' THEN 211 ELSE -211 END AS INTEGER) AS pid,
    CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END AS INTEGER) AS charge,
    CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS btag
  FROM fx_li),
fx_particles AS (
  SELECT * FROM fx_base
  UNION ALL
  SELECT event_id, 'track' AS species, pos, pt, eta, phi, x, y, z, pid, charge, btag
  FROM fx_base WHERE species IN ('electron', 'muon')),
fx_events AS (
  SELECT event_id, CAST(event_id % 3 AS INTEGER) AS label,
         CAST(count(*) FILTER (WHERE species = 'electron') AS INTEGER) AS electron_size,
         CAST(count(*) FILTER (WHERE species = 'muon') AS INTEGER) AS muon_size,
         (event_id * 7919 % 20000) / 100e0 AS met,
         ((event_id * 31) % 629 - 314) * 0.0097e0 AS met_phi
  FROM fx_particles GROUP BY event_id)"""


def wrap_sql(x: str, pi: float = 3.1415) -> str:
    """Single-step legacy wrap (inputs here are differences of two atan2 values)."""
    return (f"(CASE WHEN ({x}) >= {d(pi)} THEN ({x}) - {d(2 * pi)} "
            f"WHEN ({x}) < -{d(pi)} THEN ({x}) + {d(2 * pi)} ELSE ({x}) END)")


def most(cap: int | None) -> str:
    return "rnk" if cap is None else str(cap)


def feature_ctes(c: Cuts = DEFAULT_CUTS) -> str:
    """CTEs from the fixture to selected events (sel), kept particles (pf) and
    event features (ef). Uses the legacy wrap rule."""
    tw = d(2 * c.pi_approx)
    return FIXTURE + f""",
maps AS (
  SELECT event_id, species, pos, pt, eta, phi FROM fx_particles
  WHERE (species = 'track' AND pt > {d(c.track_pt)}) OR (species = 'photon' AND pt > {d(c.photon_et)})
     OR (species = 'neutral' AND pt > {d(c.neutral_et)})),
probes0 AS (
  SELECT *, abs(pt) * cos(phi) AS px, abs(pt) * sin(phi) AS py, abs(pt) * sinh(eta) AS pz
  FROM (SELECT event_id, species, pos, pt, eta, phi, x, y, z, pid, charge FROM fx_particles
        WHERE (species = 'track' AND pt > {d(c.track_pt)}) OR (species = 'photon' AND pt > {d(c.photon_et)})
           OR (species = 'neutral' AND pt > {d(c.neutral_et)})
           OR (species IN ('electron', 'muon') AND pt > {d(c.lep_pt)}))),
probes1 AS (
  SELECT *, sqrt(px * px + py * py + pz * pz) AS mag FROM probes0),
probes AS (
  SELECT event_id, species, pos, pt, eta, phi, x, y, z, pid, charge, px, py, pz,
         mag AS e, sqrt(px * px + py * py) AS p_pt, atan2(py, px) AS p_phi,
         CASE WHEN ct * ct < 1 THEN -0.5e0 * ln((1e0 - ct) / (1e0 + ct))
              WHEN pz = 0 THEN 0e0 END AS p_eta
  FROM (SELECT *, CASE WHEN mag = 0 THEN 1e0 ELSE pz / mag END AS ct FROM probes1)),
pairs AS (
  SELECT p.event_id, p.species, p.pos, m.species AS mspecies, m.pt AS mpt,
         (m.phi - p.p_phi) - {tw} * (CASE WHEN m.phi - p.p_phi > {tw} THEN 1e0 ELSE 0e0 END)
           + {tw} * (CASE WHEN m.phi - p.p_phi < -{tw} THEN 1e0 ELSE 0e0 END) AS dphi,
         m.eta - p.p_eta AS deta
  FROM probes p JOIN maps m ON m.event_id = p.event_id),
sums AS (
  SELECT event_id, species, pos,
         sum(mpt) FILTER (WHERE mspecies = 'track') AS s_trk,
         sum(mpt) FILTER (WHERE mspecies = 'photon') AS s_pho,
         sum(mpt) FILTER (WHERE mspecies = 'neutral') AS s_neu
  FROM pairs WHERE dphi * dphi + deta * deta < {d(c.dr)} * {d(c.dr)}
  GROUP BY event_id, species, pos),
iso AS (
  SELECT p.*,
    CASE WHEN p.p_pt <= 0 THEN 0e0 ELSE coalesce(s.s_trk, 0e0) / p.p_pt - 1e0 END AS iso_ch,
    CASE WHEN p.p_pt <= 0 THEN 0e0 ELSE coalesce(s.s_pho, 0e0) / p.p_pt END AS iso_gamma,
    CASE WHEN p.p_pt <= 0 THEN 0e0 ELSE coalesce(s.s_neu, 0e0) / p.p_pt END AS iso_neu
  FROM probes p LEFT JOIN sums s USING (event_id, species, pos)),
pre AS (
  SELECT * FROM fx_events
  WHERE (electron_size > 0 OR muon_size > 0)
    AND event_id IN (SELECT event_id FROM maps GROUP BY event_id
                     HAVING count(*) FILTER (WHERE species = 'track') > 0
                        AND count(*) FILTER (WHERE species = 'photon') > 0
                        AND count(*) FILTER (WHERE species = 'neutral') > 0)),
lep_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id, species ORDER BY pos) AS rn
    FROM iso WHERE species IN ('electron', 'muon') AND pt > {d(c.lep_pt)}
      AND iso_ch + iso_neu + iso_gamma < {d(c.iso_max)}) WHERE rn = 1),
lep_pick AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY {'p_eta' if c.lepton_rank == 'eta' else 'p_pt'} DESC,
               CASE WHEN species = 'muon' THEN 0 ELSE 1 END) AS rk
    FROM lep_first) WHERE rk = 1),
sel AS (
  SELECT e.event_id, e.label, e.met, e.met_phi, l.species AS lep_species, l.e AS lep_e,
         l.px AS lep_px, l.py AS lep_py, l.pz AS lep_pz, l.p_pt AS lep_pt, l.p_eta AS lep_eta,
         l.p_phi AS lep_phi, l.iso_ch AS lep_iso_ch, l.iso_gamma AS lep_iso_gamma,
         l.iso_neu AS lep_iso_neu, CAST(l.charge AS DOUBLE) AS lep_charge,
         CASE WHEN l.species = 'electron' THEN 1e0 ELSE 0e0 END AS lep_is_ele,
         CASE WHEN l.species = 'muon' THEN 1e0 ELSE 0e0 END AS lep_is_mu
  FROM pre e JOIN lep_pick l USING (event_id)),
obj AS (
  SELECT i.* FROM iso i JOIN sel s USING (event_id)
  WHERE i.species IN ('photon', 'neutral')
     OR (i.species = 'track' AND sqrt((s.lep_eta - i.p_eta) * (s.lep_eta - i.p_eta)
          + {wrap_sql('s.lep_phi - i.p_phi', c.pi_approx)} * {wrap_sql('s.lep_phi - i.p_phi', c.pi_approx)})
          > {d(c.overlap_dr)})),
kept0 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id, species ORDER BY pos) AS rnk FROM obj)
  WHERE rnk <= CASE species WHEN 'track' THEN {most(c.max_tracks)} WHEN 'photon' THEN {most(c.max_photons)}
                            ELSE {most(c.max_neutrals)} END),
kept AS (
  SELECT k.*, CAST(k.rnk + CASE k.species WHEN 'track' THEN 0 WHEN 'photon' THEN n.nt
                               ELSE n.nt + n.np END AS INTEGER) AS seq
  FROM kept0 k JOIN (SELECT event_id, count(*) FILTER (WHERE species = 'track') AS nt,
                            count(*) FILTER (WHERE species = 'photon') AS np
                     FROM kept0 GROUP BY event_id) n USING (event_id)),
pf AS (
  SELECT event_id, 0 AS seq, lep_species AS species, lep_e AS Energy, lep_px AS Px, lep_py AS Py,
         lep_pz AS Pz, lep_pt AS Pt, lep_eta AS Eta, lep_phi AS Phi, 0e0 AS vtxX, 0e0 AS vtxY,
         0e0 AS vtxZ, lep_iso_ch AS ChPFIso, lep_iso_gamma AS GammaPFIso, lep_iso_neu AS NeuPFIso,
         0e0 AS isChHad, 0e0 AS isNeuHad, 0e0 AS isGamma, lep_is_ele AS isEle, lep_is_mu AS isMu,
         lep_charge AS Charge
  FROM sel
  UNION ALL
  SELECT event_id, seq, species, e, px, py, pz, pt, eta, phi,
         CASE WHEN species = 'track' THEN x ELSE 0e0 END, CASE WHEN species = 'track' THEN y ELSE 0e0 END,
         CASE WHEN species = 'track' THEN z ELSE 0e0 END, iso_ch, iso_gamma, iso_neu,
         CASE WHEN species = 'track' THEN 1e0 ELSE 0e0 END,
         CASE WHEN species = 'neutral' THEN 1e0 ELSE 0e0 END,
         CASE WHEN species = 'photon' THEN 1e0 ELSE 0e0 END, 0e0, 0e0,
         CASE WHEN species <> 'track' THEN 0e0 WHEN pid < 0 THEN -1e0 WHEN pid = 0 THEN 0e0 ELSE 1e0 END
  FROM kept),
jets AS (
  SELECT event_id, CAST(count(*) AS DOUBLE) AS nJets, sum(pt) AS HT,
         CAST(count(*) FILTER (WHERE btag > 0) AS DOUBLE) AS nBjets
  FROM fx_particles WHERE species = 'jet' AND pt > {d(c.jet_pt)} AND abs(eta) < {d(c.jet_eta)}
  GROUP BY event_id),
ef AS (
  SELECT s.event_id, coalesce(j.HT, 0e0) AS HT, s.met AS MET, s.met_phi AS phiMET,
         2e0 * s.met * s.lep_pt * (1e0 - cos(s.lep_phi - s.met_phi)) AS MT,
         coalesce(j.nJets, 0e0) AS nJets, coalesce(j.nBjets, 0e0) AS nBjets,
         s.lep_pt AS LepPt, s.lep_eta AS LepEta, s.lep_phi AS LepPhi, s.lep_iso_ch AS LepIsoCh,
         s.lep_iso_gamma AS LepIsoGamma, s.lep_iso_neu AS LepIsoNeu, s.lep_charge AS LepCharge,
         s.lep_is_ele AS LepIsEle, s.label
  FROM sel s LEFT JOIN jets j USING (event_id))"""


def with_(ctes: str, select: str) -> str:
    return "WITH " + ctes + "\n" + select


def rounded(cols: list[str], prefix: str = "") -> str:
    return ", ".join(f"{r6(prefix + c)} AS {c}" for c in cols)
