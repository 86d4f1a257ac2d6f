"""Engine and persisted rollup states."""
