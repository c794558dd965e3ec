"""Operations of a training-data pipeline: rules, scores, near-duplicates, tokens, pages and conversations."""
