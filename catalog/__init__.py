"""Named queries over the test tables; each module covers one part of the inventory."""

from catalog.base import REGISTRY  # noqa: F401
from catalog import analytics, modelling, profiling, storage, texts, warehouse  # noqa: F401
