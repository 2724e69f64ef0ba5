"""snapgrid: entity-state snapshots to as-of state, dense grids, labels and profiles on Spark."""
