"""SQL text helpers for the DuckDB oracles (kept in one place so the
Spark and SQL sides round and bucket values the same way)."""


def r2(expr: str, scale: int = 2) -> str:
    """Half-up rounding on the value fixed to 6 decimals (same as
    ``round_half_up`` on the Spark side)."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,6)), {scale}) AS DOUBLE)"


def weekend(ts: str) -> str:
    """Friday or Saturday (DuckDB dayofweek: Sunday = 0)."""
    return f"dayofweek({ts}) IN (5, 6)"


def strip_ws(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def normalize(expr: str) -> str:
    """S1 in DuckDB: strip, lower, long dashes, strip_accents, drop
    non-ASCII, spaces around dashes, squeeze whitespace."""
    x = f"lower({strip_ws(expr)})"
    x = f"replace(replace({x}, '–', '-'), '—', '-')"
    x = f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"
    x = f"regexp_replace({x}, '\\s*-\\s*', '-', 'g')"
    return f"regexp_replace({x}, '\\s+', ' ', 'g')"


def spanish_text(expr: str) -> str:
    """A number rendered as '1.234,56'."""
    return f"translate(format('{{:,.2f}}', {expr}), ',.', '.,')"


def parse_spanish(expr: str) -> str:
    x = f"replace(replace(replace(trim({expr}), '.', ''), ',', '.'), '%', '')"
    return f"TRY_CAST(CASE WHEN lower({x}) IN ('', 'nan', 'none', 'null', '-', '—') THEN NULL ELSE {x} END AS DOUBLE)"
