"""Writers: upserts by natural key, prediction log, raw landing files."""
