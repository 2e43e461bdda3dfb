"""Film score mart on Spark: bronze JSON feeds -> silver tables -> gold star schema.

The main entry points, for ``from filmmart import ...``; everything else lives in the
``functions``, ``operators``, ``sources``, ``streaming`` and ``plans`` packages.
"""

from .plans.gold import build_gold
from .plans.mart import build_from_root, build_mart, register_views
from .plans.silver import build_all_silver
from .session import apply_defaults, get_spark
from .sources.feeds import bootstrap, load_batch, read_bronze_root, replace_snapshot
from .streaming.feed_stream import load_stream, replay_rejects

__all__ = ["get_spark", "apply_defaults", "load_batch", "load_stream", "replay_rejects", "replace_snapshot",
           "bootstrap", "read_bronze_root", "build_all_silver", "build_gold", "build_mart", "build_from_root",
           "register_views"]
