"""Writers for splits, token streams, statistics and documents."""
