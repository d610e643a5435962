"""Operations of a training-data pipeline, each an operator over DataFrames; ``queries`` applies them to the tables."""
