"""Cut profiles and legacy-behaviour switches."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the original pipeline for identical results.
# pi as used by the legacy phi wrap, and twice that value.
PI_APPROX = 3.1415
TWO_PI_APPROX = 2 * PI_APPROX
# Feature layout of one particle row (19 columns), in order.
PARTICLE_FEATURES = (
    "Energy", "Px", "Py", "Pz", "Pt", "Eta", "Phi",
    "vtxX", "vtxY", "vtxZ", "ChPFIso", "GammaPFIso", "NeuPFIso",
    "isChHad", "isNeuHad", "isGamma", "isEle", "isMu", "Charge",
)
# Layout of the 14 event-level features, in order.
EVENT_FEATURES = (
    "HT", "MET", "phiMET", "MT", "nJets", "nBjets", "LepPt", "LepEta",
    "LepPhi", "LepIsoCh", "LepIsoGamma", "LepIsoNeu", "LepCharge", "LepIsEle",
)
# Most particles of each kind in the padded matrix.
MATRIX_CAPS = {"max_tracks": 450, "max_photons": 150, "max_neutrals": 200}
# Class labels.
LABELS = {"qcd": 0, "ttbar": 1, "wjets": 2}


@dataclass(frozen=True)
class Cuts:
    """Selection thresholds. Defaults reproduce the original pipeline.

    ``lepton_rank`` picks the lepton when both flavours pass: ``'eta'`` (the
    original rule: electron iff its eta is larger) or ``'pt'``.
    ``wrap`` is the phi treatment inside isolation cones: ``'legacy'`` only
    wraps differences beyond 2*3.1415 (cones do not cross +-pi in practice),
    ``'periodic'`` wraps properly. Without caps (None) every particle is kept;
    the padded matrix is made with ``with_matrix_caps()``.
    """

    lep_pt: float = 23.0
    iso_max: float = 0.45
    jet_pt: float = 30.0
    jet_eta: float = 2.6
    dr: float = 0.3
    track_pt: float = 0.5
    photon_et: float = 1.0
    neutral_et: float = 1.0
    overlap_dr: float = 1e-4
    max_tracks: int | None = None
    max_photons: int | None = None
    max_neutrals: int | None = None
    lepton_rank: str = "eta"
    wrap: str = "legacy"
    pi_approx: float = PI_APPROX

    @property
    def n_rows(self) -> int:
        """Rows of the padded particle matrix: lepton + all caps."""
        c = self.with_matrix_caps()
        return 1 + c.max_tracks + c.max_photons + c.max_neutrals

    def with_matrix_caps(self) -> "Cuts":
        """These cuts with the matrix's caps where no cap is set."""
        return self.with_(**{k: n for k, n in MATRIX_CAPS.items() if getattr(self, k) is None})

    def with_(self, **kw) -> "Cuts":
        return replace(self, **kw)


DEFAULT_CUTS = Cuts()
TIGHT_CUTS = Cuts(lep_pt=25.0, iso_max=0.2, jet_pt=40.0, jet_eta=2.4)
