"""Training-data pipeline operators (quality, de-duplication, decontamination, packing)."""
