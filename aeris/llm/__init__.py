"""Training-data operators: language identification, deduplication, fingerprints, chat formatting,
tokenisation, packing and page extraction. Nothing else in the library imports this subpackage."""
