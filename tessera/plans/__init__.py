"""The query catalogue: every operator applied to the driver's tables, with
the DuckDB SQL that computes the same result (``registry.load_all``)."""
