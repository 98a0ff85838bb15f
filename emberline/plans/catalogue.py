"""All registered queries but those of the training-data operators, and their SQL."""

from __future__ import annotations

from emberline.plans import dataset, grids, land_cover, points, regions, sources, stores

QUERIES = points.QUERIES | grids.QUERIES | regions.QUERIES | land_cover.QUERIES | dataset.QUERIES | sources.QUERIES | stores.QUERIES
ORACLES = points.ORACLES | grids.ORACLES | regions.ORACLES | land_cover.ORACLES | dataset.ORACLES | sources.ORACLES | stores.ORACLES
