"""SQL fragments that repeat the library's text analysis and index formulas in DuckDB.

They are generated from the same constants the Spark side uses (``functions.text.REWRITES``, the stop
list), so a change on one side changes the other.
"""

from __future__ import annotations

from ranklight.functions.text import CONTRACTIONS, REWRITES, SPLIT, default_stopwords


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def normalize_sql(col: str) -> str:
    out = f"lower({col})"
    for kind, pattern, repl in REWRITES:
        if kind == "literal":
            out = f"replace({out}, {q(pattern)}, {q(repl)})"
        elif kind == "chars":
            out = f"translate({out}, {q(pattern)}, {q(repl * len(pattern))})"
        else:
            out = f"regexp_replace({out}, {q(pattern)}, {q(repl.replace('$1', chr(92) + '1'))}, 'g')"
    return out


def stop_list_sql(stopwords=None) -> str:
    words = default_stopwords("english") if stopwords is None else tuple(stopwords)
    if not words:
        return ""
    return " AND term NOT IN (" + ", ".join(q(w) for w in words) + ")"


def tokens_cte(name: str, source: str, id_col: str, text_col: str, out_id: str = "doc_id",
               stopwords=None) -> str:
    """CTE ``name(out_id, term)`` of kept tokens."""
    return (
        f"{name}_raw AS (SELECT {id_col} AS {out_id}, unnest(string_split({normalize_sql(text_col)}, "
        f"{q(SPLIT)})) AS term FROM {source}),\n"
        f"{name}_cut AS (SELECT {out_id}, unnest(CASE WHEN term IN ({', '.join(q(w) for w in CONTRACTIONS)}) "
        f"THEN [term[1:3], term[4:6]] ELSE [term] END) AS term FROM {name}_raw "
        f"WHERE regexp_full_match(term, '[\\p{{L}}\\p{{N}}]+')),\n"
        f"{name} AS (SELECT {out_id}, term FROM {name}_cut WHERE true{stop_list_sql(stopwords)})"
    )


def index_ctes(source: str = "documents", id_col: str = "doc_id", text_col: str = "text", stopwords=None,
               prefix: str = "") -> str:
    """CTEs ``postings, vocab, nd, weights, norms`` (names prefixed by ``prefix``)."""
    p = prefix
    return ",\n".join([
        tokens_cte(f"{p}kept", source, id_col, text_col, "doc_id", stopwords),
        f"{p}postings AS (SELECT term, doc_id, count(*)::BIGINT AS tf FROM {p}kept GROUP BY term, doc_id)",
        f"{p}vocab AS (SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM {p}postings GROUP BY term)",
        f"{p}nd AS (SELECT count(*)::BIGINT AS n FROM {source})",
        f"{p}weights AS (SELECT p.term, p.doc_id, p.tf, v.df, (1 + log10(p.tf::DOUBLE)) * log10({p}nd.n::DOUBLE / v.df) AS w "
        f"FROM {p}postings p JOIN {p}vocab v USING (term) CROSS JOIN {p}nd)",
        f"{p}norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm, sum(tf)::BIGINT AS dl FROM {p}weights GROUP BY doc_id)",
    ])


def query_ctes(source: str = "benchmark", id_col: str = "item_id", text_col: str = "text", stopwords=None,
               prefix: str = "") -> str:
    """CTEs ``qtf(query_id, term, qtf, df)`` over the vocabulary, needs ``index_ctes`` first."""
    p = prefix
    return ",\n".join([
        tokens_cte(f"{p}qkept", source, id_col, text_col, "query_id", stopwords),
        f"{p}qtf AS (SELECT t.query_id, t.term, count(*)::BIGINT AS qtf, any_value(v.df) AS df FROM {p}qkept t "
        f"JOIN {p}vocab v USING (term) GROUP BY t.query_id, t.term)",
    ])


def cosine_ctes(prefix: str = "") -> str:
    """CTE ``scores(query_id, doc_id, score)``; needs index and query CTEs."""
    p = prefix
    return ",\n".join([
        f"{p}qw AS (SELECT query_id, term, (1 + log10(qtf::DOUBLE)) * log10({p}nd.n::DOUBLE / df) AS qw FROM {p}qtf CROSS JOIN {p}nd)",
        f"{p}qnorm AS (SELECT query_id, sqrt(sum(qw * qw)) AS qnorm FROM {p}qw GROUP BY query_id)",
        f"{p}dots AS (SELECT q.query_id, w.doc_id, sum(q.qw * w.w) AS dot FROM {p}qw q JOIN {p}weights w USING (term) "
        f"GROUP BY q.query_id, w.doc_id)",
        f"{p}scores AS (SELECT d.query_id, d.doc_id, d.dot / nullif(n.qnorm * m.norm, 0) AS score FROM {p}dots d "
        f"JOIN {p}qnorm n USING (query_id) JOIN {p}norms m USING (doc_id))",
    ])


def top_k_sql(source: str, k: int, key: str = "query_id", score: str = "score", item: str = "doc_id",
              descending: bool = True, cols: str = "query_id, rank, doc_id, round(score, 6) AS score") -> str:
    direction = "DESC" if descending else "ASC"
    return (
        f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY round({score}, 9) {direction}, "
        f"{item}) :: BIGINT AS rank FROM {source} WHERE {score} IS NOT NULL) WHERE rank <= {k}"
    )
