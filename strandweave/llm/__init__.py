"""Operations on training-data corpora: deduplication, filters, scoring, mixing and tokenisation."""
