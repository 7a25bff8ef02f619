"""Operations of a training-data pipeline: packing, scanning, near copies, archives, scoring, tokens."""
