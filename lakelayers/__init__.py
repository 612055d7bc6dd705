"""Layered table jobs on Spark: landed JSON Lines to bronze, silver and gold tables."""

from lakelayers.names import LAYERS, TableRef, layer_database, layer_table, raw_folder
from lakelayers.plans.chain import Entity, LayerRun, run_chain, run_layer

__all__ = [
    "LAYERS", "Entity", "LayerRun", "TableRef", "layer_database", "layer_table", "raw_folder",
    "run_chain", "run_layer",
]
