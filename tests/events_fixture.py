"""Hand-built and random nested events for brute-force checks."""

from __future__ import annotations

import math
import random

from collidex import schemas


def trk(pt, eta, phi, pid=211, x=0.1, y=0.2, z=0.3):
    return dict(PT=float(pt), Eta=float(eta), Phi=float(phi), X=float(x), Y=float(y), Z=float(z),
                PID=int(pid))


def tow(et, eta, phi):
    return dict(ET=float(et), Eta=float(eta), Phi=float(phi))


def lep(pt, eta, phi, q=1):
    return dict(PT=float(pt), Eta=float(eta), Phi=float(phi), Charge=int(q))


def jet(pt, eta, b=0):
    return dict(PT=float(pt), Eta=float(eta), BTag=int(b))


def event(eid, tracks=(), neutrals=(), photons=(), eles=(), mus=(), jets=(), met=(50.0, 0.5),
          e_size=None, m_size=None, label=1):
    return dict(event_id=eid, EFlowTrack=list(tracks), EFlowNeutralHadron=list(neutrals),
                EFlowPhoton=list(photons), Electron=list(eles), MuonTight=list(mus),
                Electron_size=len(eles) if e_size is None else e_size,
                MuonTight_size=len(mus) if m_size is None else m_size,
                MissingET=[dict(MET=float(met[0]), Phi=float(met[1]))], Jet=list(jets), label=label)


BASE_T = [trk(5.0, 0.5, 1.0), trk(3.0, -1.0, -2.0, pid=-211), trk(0.4, 0.0, 0.0), trk(2.0, 1.1, 1.2)]
BASE_N = [tow(4.0, 0.8, 2.5), tow(0.9, 0.1, 0.1), tow(2.0, -0.7, -1.1)]
BASE_P = [tow(3.0, -0.3, 0.2), tow(1.5, 2.0, -2.9)]


def edge_events():
    e = []
    e.append(event(1, BASE_T, BASE_N, [tow(0.5, 0, 0)], eles=[lep(30, 0.1, 0.1)]))          # empty photon map
    e.append(event(2, BASE_T, BASE_N, BASE_P, eles=[lep(30, 0.1, -0.7)]))                  # only electron
    e.append(event(3, BASE_T, BASE_N, BASE_P, mus=[lep(40, -1.5, 2.8, -1)]))               # only muon
    e.append(event(4, BASE_T, BASE_N, BASE_P, eles=[lep(30, 0.7, -0.6)],
                   mus=[lep(35, 0.7, 2.0)]))                                               # equal eta -> muon
    e.append(event(5, BASE_T, BASE_N, BASE_P, eles=[lep(30, 1.9, -0.6)],
                   mus=[lep(35, 0.2, 2.0)]))                                               # electron wins
    e.append(event(6, BASE_T + [trk(30, -0.2, 0.9)], BASE_N, BASE_P,
                   eles=[lep(30, -0.2, 0.9)], jets=[jet(50, 1.0, 1), jet(20, 0.1), jet(60, 3.0)]))  # overlap
    e.append(event(7, BASE_T + [trk(1.0, 0.3, 0.3, pid=0)], BASE_N, BASE_P,
                   mus=[lep(25, 0.0, 0.0)], met=(0.0, 0.0)))                               # PID 0, MET 0
    e.append(event(8, [trk(1.0 + i, 0.05 * i - 1, 0.1 * i) for i in range(12)], BASE_N * 3, BASE_P * 3,
                   eles=[lep(60, 2.2, 1.0)]))                                              # many tracks (caps)
    e.append(event(9, BASE_T + [trk(2.0, 0.2, 3.1), trk(2.0, 0.2, -3.1)], BASE_N,
                   BASE_P + [tow(2.0, 0.25, 3.05)], mus=[lep(26, 0.2, 3.12)]))             # near +-pi
    e.append(event(10, BASE_T, BASE_N, BASE_P, eles=[lep(30, 0.1, 0.1)], e_size=0, m_size=0))  # counters 0
    e.append(event(11, BASE_T + [trk(20, 0.1, 0.15)], BASE_N, BASE_P,
                   eles=[lep(30, 0.1, 0.1), lep(28, -1.3, -2.2)]))                         # first not isolated
    e.append(event(12, BASE_T, BASE_N, BASE_P, eles=[lep(20, 0.1, 0.1)]))                  # below pt cut
    return e


def random_events(n=40, seed=3):
    rng = random.Random(seed)

    def ang():
        return rng.uniform(-math.pi, math.pi)

    out = []
    for i in range(n):
        nt, nn, npho = rng.randint(0, 40), rng.randint(0, 15), rng.randint(0, 15)
        tracks = [trk(rng.expovariate(0.3), rng.uniform(-2.5, 2.5), ang(), rng.choice([-211, 0, 211]),
                      rng.random(), rng.random(), rng.random()) for _ in range(nt)]
        eles = [lep(rng.uniform(10, 80), rng.uniform(-2.4, 2.4), ang(), rng.choice([-1, 1]))
                for _ in range(rng.randint(0, 2))]
        mus = [lep(rng.uniform(10, 80), rng.uniform(-2.4, 2.4), ang(), rng.choice([-1, 1]))
               for _ in range(rng.randint(0, 2))]
        tracks += [trk(l["PT"], l["Eta"], l["Phi"]) for l in eles + mus if rng.random() < 0.7]
        rng.shuffle(tracks)
        out.append(event(
            100 + i, tracks,
            [tow(rng.expovariate(0.4), rng.uniform(-2.5, 2.5), ang()) for _ in range(nn)],
            [tow(rng.expovariate(0.4), rng.uniform(-2.5, 2.5), ang()) for _ in range(npho)],
            eles, mus, [jet(rng.uniform(10, 120), rng.uniform(-4, 4), rng.randint(0, 1)) for _ in range(rng.randint(0, 6))],
            met=(rng.uniform(0, 200), ang()), label=i % 3))
    return out


def to_df(spark, events):
    return spark.createDataFrame(events, schemas.EVENT)
