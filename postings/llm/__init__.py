"""Operations of a training-data pipeline on tables of documents and vectors."""
