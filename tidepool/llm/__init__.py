"""Operations of a training-data pipeline: cleaning, deduplication, mixing, packing, token files."""
