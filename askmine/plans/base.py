"""What the query modules share: the registry, table access, and SQL that several queries need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from askmine.functions import text as t
from askmine.operators import terms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
HMAC_KEY = b"query key"


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("'", "''") + "'"


#: SQL of a thread's rank from its key.
RANK = "CAST(('0x' || substr(sha256('42:' || CAST({k} AS VARCHAR)), 1, 16)) AS UBIGINT)::DOUBLE / 18446744073709551616.0"
FLAT_QUOTE_SQL = quoted(t.FLAT_QUOTE)[1:-1]
HANDLE_SQL = r"regexp_matches({c}, '(^|[^\p{{L}}\p{{N}}_@.<])@[A-Za-z][A-Za-z0-9_.]')"
TRIPWIRE_SQL = (
    r"(regexp_matches({c}, '(^|[^0-9])(\+?1[\s.-]?)?\(?[0-9]{{3}}\)?[\s.-]?[0-9]{{3}}[\s.-][0-9]{{4}}([^0-9]|$)') OR regexp_matches({c}, '[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+(\.[\p{{L}}\p{{N}}_-]+)+')"
    r" OR regexp_matches({c}, '(?i)\bhttps?://\S|\bwww\.\S') OR " + HANDLE_SQL + ")"
)
_STOPS = ", ".join(f"'{w}'" for w in terms.STOP_WORDS)
TERMS_SQL = f"""toks AS (SELECT {{key}} AS k, g, list_filter(regexp_extract_all(lower(regexp_replace(text, '<[A-Z_]+>', ' ', 'g')), '[\\p{{{{L}}}}\\p{{{{N}}}}_]+'), lambda x: regexp_full_match(x, '\\p{{{{L}}}}{{{{2,}}}}')) AS w FROM (SELECT {{key}}, {{group}} AS g, text FROM {{table}})),
clean AS (SELECT g, list_filter(w, lambda x: x NOT IN ({_STOPS})) AS w FROM toks),
each AS (SELECT g, unnest(w) AS term FROM clean UNION ALL SELECT g, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM clean),
cnt AS (SELECT g, term, count(*) AS n_term FROM each GROUP BY 1, 2), grp AS (SELECT g, sum(n_term)::BIGINT AS n_group FROM cnt GROUP BY 1),
corp AS (SELECT term, sum(n_term)::BIGINT AS n_corpus FROM cnt GROUP BY 1), m AS (SELECT avg(n_group) AS mean FROM grp),
sc AS (SELECT g, term, n_term, round(n_term::DOUBLE / n_group * ln(1 + mean / n_corpus), 9) AS score FROM cnt JOIN grp USING (g) JOIN corp USING (term), m),
top AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY score DESC, term)::INTEGER AS rank, term, n_term FROM sc QUALIFY rank <= 8)"""
