"""DataFrame -> DataFrame operators. Every operator returns a lazy
DataFrame; nothing is collected to the driver except bounded metadata
(row-count checks against a fixed limit, one row per partition)."""
