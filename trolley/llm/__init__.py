"""Training-data operators: mixing, extraction, token output, packing, filters, search and near-dedup."""
