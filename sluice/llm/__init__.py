"""Training-data operators: dedup, decontamination, search, language ID, packing, URL filters,
quality, token counts and chat formatting. Nothing else in the package imports this subpackage."""
