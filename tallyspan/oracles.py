"""Independent SQL for the registered queries, for DuckDB on the same tables.

Iterative operators are written out round by round as common table
expressions. Doubles are rounded to 6 places on both sides, since the engines
add coordinates in different orders.
"""

from __future__ import annotations

import re

from tallyspan.functions.keys import SEED

_TOKENS = """
  SELECT doc_id, unnest(CASE
      WHEN text = '' THEN ['']
      WHEN rtrim(text, ' ') = '' THEN []::VARCHAR[]
      ELSE string_split(rtrim(text, ' '), ' ') END) AS word
  FROM documents"""

_POINTS = "pts AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings)"


def random_order(key: str, seed: int = SEED) -> str:
    return f"substr(md5('{seed}:' || {key}), 1, 15)"


def _number(key: str, seed: int = SEED) -> str:
    return f"('0x' || {random_order(key, seed)})::BIGINT"


def with_clause(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def center_ctes(k: int, parts: int) -> list[str]:
    """Farthest-first traversal of ``id mod parts``: tables c1..ck, and centers."""
    return [_POINTS, *_traversal_ctes(k, f"SELECT *, id % {parts} AS part FROM pts")]


def upper_center_ctes(k: int, fan: int) -> list[str]:
    """The traversal of ``fan`` parts' centers at a time: all tables above named anew, and upper_centers."""
    ctes = _traversal_ctes(k, f"SELECT id, x, part // {fan} AS part FROM centers")
    return [re.sub(r"\b(part_pts|centers(?= AS)|[cm]\d+)\b", r"upper_\1", cte) for cte in ctes]


def _traversal_ctes(k: int, parted: str) -> list[str]:
    ctes = [
        f"part_pts AS MATERIALIZED ({parted})",
        "c1 AS MATERIALIZED (SELECT part, id, x, NULL::DOUBLE AS d FROM part_pts QUALIFY"
        f" row_number() OVER (PARTITION BY part ORDER BY {random_order('id')}, id) = 1)",
        "m1 AS MATERIALIZED (SELECT p.part, p.id, p.x, list_distance(p.x, c.x) AS d"
        " FROM part_pts p JOIN c1 c USING (part))",
    ]
    for r in range(2, k + 1):
        earlier = " UNION ALL ".join(f"SELECT id FROM c{i}" for i in range(1, r))
        ctes += [
            f"c{r} AS MATERIALIZED (SELECT part, id, x, d FROM m{r - 1}"
            f" WHERE id NOT IN ({earlier})"
            " QUALIFY row_number() OVER (PARTITION BY part ORDER BY d DESC, id) = 1)",
            f"m{r} AS MATERIALIZED (SELECT m.part, m.id, m.x,"
            f" least(m.d, coalesce(list_distance(m.x, c.x), m.d)) AS d"
            f" FROM m{r - 1} m LEFT JOIN c{r} c USING (part))",
        ]
    union = " UNION ALL ".join(
        f"SELECT part, {r} AS rank, id, x, d FROM c{r}" for r in range(1, k + 1)
    )
    return ctes + [f"centers AS MATERIALIZED ({union})"]


def matching_ctes(k: int, centers: str = "centers") -> list[str]:
    """Greedy matching on ``centers``: table solution(rank, id, x)."""
    ctes = [
        "pairs AS MATERIALIZED (SELECT a.id AS i, b.id AS j,"
        f" list_distance(a.x, b.x) ** 2 AS d2 FROM {centers} a JOIN {centers} b ON a.id < b.id)"
    ]
    chosen: list[str] = []
    for r in range(1, k // 2 + 1):
        free = ""
        if chosen:
            used = " UNION ALL ".join(chosen)
            free = f" WHERE i NOT IN ({used}) AND j NOT IN ({used})"
        ctes.append(
            f"g{r} AS MATERIALIZED (SELECT i, j FROM pairs{free} ORDER BY d2 DESC, i, j LIMIT 1)"
        )
        chosen += [f"SELECT i FROM g{r}", f"SELECT j FROM g{r}"]
    picks = [
        f"SELECT {2 * r - 1 + at} AS rank, {side} AS id FROM g{r}"
        for r in range(1, k // 2 + 1)
        for at, side in enumerate("ij")
    ]
    if k % 2:
        free = f" WHERE id NOT IN ({' UNION ALL '.join(chosen)})" if chosen else ""
        picks.append(f"SELECT {k} AS rank, min(id) AS id FROM {centers}{free}")
    union = " UNION ALL ".join(picks)
    return ctes + [
        f"solution AS MATERIALIZED (SELECT s.rank, s.id, c.x FROM ({union}) s"
        f" JOIN {centers} c ON s.id = c.id)"
    ]


_AVERAGE = (
    "SELECT round(avg(list_distance(a.x, b.x)), 6) AS avg_distance"
    " FROM solution a JOIN solution b ON a.id < b.id"
)


def _sample(k: int) -> str:
    return f"(SELECT id, x FROM pts ORDER BY {random_order('id')}, id LIMIT {k})"


def _exact(points: str) -> str:
    return (
        f"SELECT coalesce(max(list_distance(a.x, b.x)), 0.0) AS d"
        f" FROM {points} a JOIN {points} b ON a.id < b.id"
    )


def _two_approx(k: int) -> str:
    return f"SELECT max(list_distance(p.x, s.x)) AS d FROM pts p CROSS JOIN {_sample(k)} s"


def oracle_sql(parts: int, k: int, k_even: int, k_odd: int, chunk: int, fan: int) -> dict[str, str]:
    """SQL for every registered query, with the parameters the queries use."""
    by_class = "SELECT event_type AS gamma, count(*) AS n FROM events GROUP BY 1"
    words = f"WITH tokens AS ({_TOKENS}) SELECT word, count(*) AS n FROM tokens GROUP BY 1"
    draws = f"(SELECT range + 1 AS draw, {_number('range')} % (SELECT count(*) FROM pts) AS pos FROM range({k}))"
    lengths = (
        "sum(length(word))::BIGINT // count(*) AS avg_length,"
        " round(sum(length(word)) / count(*), 6) AS avg_length_exact"
    )
    one = center_ctes(k, 1)
    many = center_ctes(k_even, parts)
    matched = many + matching_ctes(k_even)
    shortlist = 2 * (k_even // 2 - 1) * (k_even * parts - 1) + 1

    def summary(table: str, key: str, cls: str) -> str:
        return (
            f"WITH c AS (SELECT {cls} AS gamma, count(*) AS n FROM {table} GROUP BY 1),"
            f" s AS (SELECT {key} % {parts} AS part, count(*) AS n FROM {table} GROUP BY 1),"
            " t AS (SELECT gamma, n FROM c ORDER BY n DESC, gamma LIMIT 1)"
            " SELECT t.gamma AS most_frequent_class, t.n AS class_size,"
            " (SELECT max(n) FROM s) AS max_partition_size FROM t"
        )

    return {
        "text_scan": "SELECT event_id || ' ' || event_type AS value FROM events",
        "decode_pairs": "SELECT event_id AS i, event_type AS gamma FROM events",
        "decode_points": "SELECT vec_id AS point_id, (pos - 1)::INTEGER AS pos, round(x, 6) AS x FROM ("
        " SELECT vec_id, unnest(embedding::DOUBLE[]) AS x,"
        " unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)",
        "partition_key": f"SELECT event_id AS i, event_id % {parts} AS part,"
        f" event_id % {parts} AS part_signed FROM events",
        "class_count_round1": f"SELECT event_id % {parts} AS part, event_type AS gamma,"
        " count(*) AS n FROM events GROUP BY 1, 2",
        "class_count": by_class,
        "class_count_two_round": by_class,
        "class_count_physical": by_class,
        "class_count_brands": "SELECT p_brand AS gamma, count(*) AS n FROM part GROUP BY 1",
        "partition_sizes": f"SELECT event_id % {parts} AS part, count(*) AS size"
        " FROM events GROUP BY 1",
        "partition_sizes_physical": f"SELECT {parts}::BIGINT AS parts, least({parts}, count(*))::BIGINT AS filled,"
        " count(*) AS objects FROM events",
        "max_partition_size": "SELECT max(n) AS max_partition_size FROM"
        f" (SELECT count(*) AS n FROM events GROUP BY event_id % {parts})",
        "most_frequent_class": by_class + " ORDER BY n DESC, gamma LIMIT 1",
        "class_summary": summary("events", "event_id", "event_type"),
        "class_summary_lineitem": summary("lineitem", "l_orderkey", "l_returnflag"),
        "group_values": "SELECT gamma, chunk, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids"
        " FROM (SELECT event_type AS gamma, event_id, (row_number() OVER"
        f" (PARTITION BY event_type ORDER BY event_id) - 1) // {chunk} AS chunk FROM events) GROUP BY 1, 2",
        "doc_token_counts": f"WITH tokens AS ({_TOKENS})"
        " SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY 1, 2",
        "word_count": words,
        "word_count_salted": words,
        "word_count_partitioned": words,
        "distinct_words": f"WITH tokens AS ({_TOKENS})"
        " SELECT count(DISTINCT word) AS distinct_words FROM tokens",
        "avg_word_length": f"WITH tokens AS ({_TOKENS}) SELECT {lengths}"
        " FROM (SELECT DISTINCT word FROM tokens)",
        "word_summary": f"WITH tokens AS ({_TOKENS}) SELECT"
        f" (SELECT count(*) FROM documents) AS documents, count(*) AS distinct_words, {lengths}"
        " FROM (SELECT DISTINCT word FROM tokens)",
        "row_counts": "SELECT 'documents' AS name, count(*) AS n FROM documents"
        " UNION ALL SELECT 'embeddings', count(*) FROM embeddings",
        "point_distances": with_clause(
            [_POINTS],
            f"SELECT p.id AS point_id, round(list_distance(p.x, c.x) ** 2, 6) AS d2,"
            f" round(list_distance(p.x, c.x), 6) AS d FROM pts p CROSS JOIN {_sample(1)} c",
        ),
        "exact_mpd": with_clause(
            [_POINTS], f"SELECT round(d, 6) AS max_distance FROM ({_exact('pts')})"
        ),
        "sample_points": with_clause(
            [_POINTS],
            f"SELECT row_number() OVER (ORDER BY {random_order('id')}, id)::INTEGER AS draw,"
            f" id AS point_id FROM {_sample(k)}",
        ),
        "sample_points_repl": with_clause(
            [_POINTS],
            "SELECT d.draw::INTEGER AS draw, p.id AS point_id FROM"
            f" {draws} d JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos FROM pts) p"
            " ON d.pos = p.pos",
        ),
        "two_approx_mpd": with_clause(
            [_POINTS], f"SELECT round(d, 6) AS max_distance FROM ({_two_approx(k)})"
        ),
        "k_center": with_clause(
            one, "SELECT rank, id AS point_id, round(d, 6) AS distance FROM centers"
        ),
        "min_distance": with_clause(
            one, f"SELECT id AS point_id, round(d, 6) AS min_dist FROM m{k}"
        ),
        "k_center_mpd": with_clause(
            one, f"SELECT round(d, 6) AS max_distance FROM ({_exact('centers')})"
        ),
        "mpd_compare": with_clause(
            one,
            f"SELECT 'exact' AS algorithm, NULL::INTEGER AS k, round(d, 6) AS max_distance"
            f" FROM ({_exact('pts')})"
            f" UNION ALL SELECT 'sample', {k}, round(d, 6) FROM ({_two_approx(k)})"
            f" UNION ALL SELECT 'k_center', {k}, round(d, 6) FROM ({_exact('centers')})",
        ),
        "coreset": with_clause(
            many, "SELECT part, rank, id AS point_id, round(d, 6) AS distance FROM centers"
        ),
        "coreset_pairs": with_clause(
            matched,
            "SELECT i, j, round(d2, 6) AS d2 FROM"
            f" (SELECT * FROM pairs ORDER BY d2 DESC, i, j LIMIT {shortlist})",
        ),
        "greedy_matching": with_clause(matched, "SELECT rank, id AS point_id FROM solution"),
        "greedy_matching_odd": with_clause(
            many + matching_ctes(k_odd), "SELECT rank, id AS point_id FROM solution"
        ),
        "remaining_candidates": with_clause(
            matched, "SELECT id AS point_id FROM centers WHERE id NOT IN (SELECT id FROM solution)"
        ),
        "diversity_max": with_clause(matched, "SELECT rank, id AS point_id FROM solution"),
        "diversity_max_levels": with_clause(
            center_ctes(k_even, parts * fan) + upper_center_ctes(k_even, fan) + matching_ctes(k_even, "upper_centers"),
            "SELECT rank, id AS point_id FROM solution",
        ),
        "avg_pairwise_distance": with_clause(matched, _AVERAGE),
        "diversity_report": with_clause(
            matched,
            f"SELECT (SELECT count(*) FROM pts) AS n, {k_even} AS k, {parts} AS parts,"
            f" (SELECT count(*) FROM centers) AS coreset_size, avg_distance FROM ({_AVERAGE})",
        ),
    }
