"""Training-data operators: sharding, decontamination, dedup, archives, scoring, packing, scans."""
