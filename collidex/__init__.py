"""collidex: Spark-native preparation and analysis of particle-collision events.

The package keeps every stage of the event pipeline inside Spark SQL:
nested event rows are flattened into a particle relation keyed by
``event_id``; selection, cone isolation, feature building, sequences and
images are joins, windows and aggregations over that relation.
"""

from collidex.config import Cuts, DEFAULT_CUTS, TIGHT_CUTS

__all__ = ["Cuts", "DEFAULT_CUTS", "TIGHT_CUTS"]
