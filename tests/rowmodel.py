"""Brute-force event model for the tests: whole-array arithmetic on one event.

table; cone sums come from one matrix of distances per kind of candidate, caps
are slices, and a particle is a record by feature name.
"""

from __future__ import annotations

import numpy as np

from collidex.config import EVENT_FEATURES, PARTICLE_FEATURES

HALF_TURN = 3.1415          # fixed value: the rounded pi of the wrap
CONE, OVERLAP = 0.3, 1e-4
# fixed values: branch, momentum field, threshold, isolation column, flag
KINDS = {"track": ("EFlowTrack", "PT", 0.5, "ChPFIso", "isChHad"),
         "photon": ("EFlowPhoton", "ET", 1.0, "GammaPFIso", "isGamma"),
         "neutral": ("EFlowNeutralHadron", "ET", 1.0, "NeuPFIso", "isNeuHad")}
LEPTONS = {"isEle": "Electron", "isMu": "MuonTight"}


def wrapped(angle):
    """Angle reduced to [-3.1415, 3.1415) in closed form."""
    return angle - 2 * HALF_TURN * np.floor((angle + HALF_TURN) / (2 * HALF_TURN))


def table(items: list[dict], momentum: str) -> dict[str, np.ndarray]:
    """Columns of the items, with the four-vector of a massless object and the angles read back from it."""
    raw = {k: np.array([x[k] for x in items], float) for k in (momentum, "Eta", "Phi")}
    size = np.abs(raw[momentum])
    vec = np.stack([size * np.cos(raw["Phi"]), size * np.sin(raw["Phi"]), size * np.sinh(raw["Eta"])])
    energy = np.linalg.norm(vec, axis=0)
    slope = np.divide(vec[2], energy, out=np.zeros_like(energy), where=energy > 0)
    return {"Pt": raw[momentum], "Eta": raw["Eta"], "Phi": raw["Phi"], "Energy": energy, "Px": vec[0], "Py": vec[1], "Pz": vec[2],
            "pt4": np.hypot(vec[0], vec[1]), "eta4": np.arctanh(slope), "phi4": np.arctan2(vec[1], vec[0])}


def cone_sums(probes: dict, candidates: dict) -> np.ndarray:
    """Candidate momentum within the cone of each probe over the probe's own; 0 for a probe without momentum."""
    d_eta = np.subtract.outer(probes["eta4"], candidates["Eta"])
    d_phi = np.subtract.outer(probes["phi4"], candidates["Phi"])
    d_phi = d_phi - 2 * HALF_TURN * np.sign(d_phi) * (np.abs(d_phi) > 2 * HALF_TURN)
    total = (np.square(d_eta) + np.square(d_phi) < CONE ** 2) @ candidates["Pt"]
    return np.divide(total, probes["pt4"], out=np.zeros_like(total), where=probes["pt4"] > 0)


def records(items: list[dict], momentum: str, maps: dict[str, dict]) -> list[dict]:
    """One record per item: columns of :func:`table` and the three isolations (a charged probe counts itself)."""
    if not items:
        return []
    cols = table(items, momentum)
    for kind, (_, _, _, iso, _) in KINDS.items():
        cols[iso] = cone_sums(cols, maps[kind])
    cols["ChPFIso"] = np.where(cols["pt4"] > 0, cols["ChPFIso"] - 1, cols["ChPFIso"])
    return [{name: float(v[i]) for name, v in cols.items()} | {"item": x} for i, x in enumerate(items)]


def model(ev: dict, lep_pt=23.0, iso_max=0.45, caps=(None, None, None), jet_pt=30.0, jet_eta=2.6):
    """(particle rows, event features) of a selected event, or None when it is rejected."""
    items = {kind: [x for x in ev[branch] if x[m] > least] for kind, (branch, m, least, _, _) in KINDS.items()}
    if not all(items.values()) or not (ev["Electron_size"] or ev["MuonTight_size"]):
        return None
    maps = {kind: table(items[kind], KINDS[kind][1]) for kind in KINDS}

    chosen = []
    for flag, branch in LEPTONS.items():
        good = [r for r in records([x for x in ev[branch] if x["PT"] > lep_pt], "PT", maps)
                if r["ChPFIso"] + r["NeuPFIso"] + r["GammaPFIso"] < iso_max]
        chosen += [r | {flag: 1.0} for r in good[:1]]
    if not chosen:
        return None
    # electrons stand first; a muon replaces one unless the electron's eta is larger
    lep = chosen[0] if len(chosen) == 1 or chosen[0]["eta4"] > chosen[1]["eta4"] else chosen[1]
    lep = lep | {"Pt": lep["pt4"], "Eta": lep["eta4"], "Phi": lep["phi4"], "Charge": float(lep["item"]["Charge"])}

    particles = [lep]
    for (kind, (_, momentum, _, _, flag)), most in zip(KINDS.items(), caps):
        found = records(items[kind], momentum, maps)
        if kind == "track":
            found = [r | {"vtxX": r["item"]["X"], "vtxY": r["item"]["Y"], "vtxZ": r["item"]["Z"], "Charge": float(np.sign(r["item"]["PID"]))}
                     for r in found if np.hypot(lep["eta4"] - r["eta4"], wrapped(lep["phi4"] - r["phi4"])) > OVERLAP]
        particles += [r | {flag: 1.0} for r in found[:most]]

    met = ev["MissingET"][0]
    jets = [j for j in ev["Jet"] if j["PT"] > jet_pt and abs(j["Eta"]) < jet_eta]
    event = {"HT": sum(j["PT"] for j in jets), "nJets": len(jets), "nBjets": len([j for j in jets if j["BTag"] > 0]),
             "MET": met["MET"], "phiMET": met["Phi"], "MT": 2.0 * met["MET"] * lep["Pt"] * (1 - np.cos(lep["Phi"] - met["Phi"])),
             "LepPt": lep["Pt"], "LepEta": lep["Eta"], "LepPhi": lep["Phi"], "LepIsoCh": lep["ChPFIso"], "LepIsoGamma": lep["GammaPFIso"],
             "LepIsoNeu": lep["NeuPFIso"], "LepCharge": lep["Charge"], "LepIsEle": lep.get("isEle", 0.0)}
    return [[float(r.get(c, 0.0)) for c in PARTICLE_FEATURES] for r in particles], [float(event[c]) for c in EVENT_FEATURES]
