"""Training-data operators: search, licences, quality, decontamination, WARC, near duplicates, mixing, language models."""
