"""DuckDB statements of personal data, clustering and importance resampling, with the columns of their queries."""

from __future__ import annotations

from . import importance, pii, vafile


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _pii() -> str:
    """Spans by marking every match, splitting at the marks and summing lengths."""
    kinds = list(pii.KINDS)
    patterns = " UNION ALL ".join(
        f"SELECT r, t, {i} AS k, regexp_replace(t, '{pii.PATTERNS[kind]}', chr(57344) || '\\0' || chr(57345), 'g') AS marked FROM d" for i, kind in enumerate(kinds)
    )
    number = {kind: i for i, kind in enumerate(kinds)}
    digit = "substr(digits, length(digits) - i + 1, 1)::INTEGER"
    luhn = f"list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0"
    turned = "substr(account, 5) || substr(account, 1, 4)"
    as_digits = f"array_to_string(list_transform(string_split({turned}, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END), '')"
    mod97 = f"list_reduce(list_transform(string_split({as_digits}, ''), lambda c: c::INTEGER), lambda a, b: (a * 10 + b) % 97) = 1"
    wide = "list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(right(p, 3) AS INTEGER), 0) > 255)"
    sizes = ", ".join(f"('{c}', {n})" for c, n in sorted(pii.LENGTH.items()))
    words = " ".join(f"WHEN {number[kind]} THEN regexp_matches(around, '{pii.near_pattern(w)}')" for kind, w in pii.FOR.items())
    prior = " ".join(f"WHEN {number[k]} THEN {v + (pii.CHECKSUM if k in ('card', 'iban') else 0)}" for k, v in pii.PRIORS.items())
    last_base = len(pii.BASE) - 1
    names = f"[{_list(kinds)}]"
    count = ", ".join(f"(count(*) FILTER (k = {i}))::BIGINT AS n_{kind}" for i, kind in enumerate(pii.BASE))
    joined = f"string_agg({names}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k)"
    return rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(57344) || chr(57345), '??') AS t FROM documents),
        size (country, n) AS (VALUES {sizes}),
        marked AS ({patterns}),
        piece AS (SELECT r, t, k, unnest(string_split(marked, chr(57344))) AS p, generate_subscripts(string_split(marked, chr(57344)), 1) AS i FROM marked),
        placed AS (
            SELECT *, (sum(length(p)) OVER w - length(p) - greatest(i - 2, 0))::BIGINT AS s FROM piece
            WINDOW w AS (PARTITION BY r, k ORDER BY i ROWS UNBOUNDED PRECEDING)),
        match AS (SELECT r, t, k, s, string_split(p, chr(57345))[1] AS m, regexp_replace(string_split(p, chr(57345))[1], '[^0-9]', '', 'g') AS digits FROM placed WHERE i > 1),
        iban AS (
            SELECT r, k, s, n + CASE WHEN substr(m, 5, 1) = ' ' THEN (n - 1) // 4 ELSE 0 END AS cut, m
            FROM match JOIN size ON substr(m, 1, 2) = country WHERE k = {number['iban']}),
        valid AS (
            SELECT r, k, s, s + length(m) AS e FROM match
            WHERE k = {number['email']}
               OR (k = {number['ip']} AND len({wide}) = 0)
               OR (k = {number['card']} AND length(digits) BETWEEN 14 AND 19 AND {luhn})
               OR (k = {number['phone']} AND length(digits) BETWEEN 10 AND 15)
               OR (k = {number['ssn']} AND substr(digits, 1, 3) NOT IN ('000', '666') AND substr(digits, 1, 1) <> '9'
                   AND substr(digits, 4, 2) <> '00' AND substr(digits, 6) <> '0000')
               OR k = {number['local_phone']}
            UNION ALL
            SELECT r, k, s, s + cut AS e
            FROM (SELECT *, replace(substr(m, 1, cut), ' ', '') AS account FROM iban WHERE cut <= length(m) AND substr(m, cut + 1, 1) IN ('', ' '))
            WHERE {mod97}),
        near AS (
            SELECT v.*, substr(low, greatest(s - {pii.NEAR}, 0) + 1, least(s, {pii.NEAR})) || chr(10) || substr(low, e + 1, {pii.NEAR}) AS around
            FROM valid AS v JOIN (SELECT r, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d) USING (r)),
        scored AS (
            SELECT r, k, s, e, greatest(0, least(100, CASE k {prior} END + CASE WHEN CASE k {words} END THEN {pii.CONTEXT} ELSE 0 END
                   - CASE WHEN regexp_matches(around, '{pii.near_pattern(pii.AGAINST)}') THEN {pii.CONTEXT} ELSE 0 END)) AS score
            FROM near),
        kept AS (
            SELECT * FROM scored WHERE k <= {last_base}
            UNION ALL
            SELECT a.* FROM scored AS a
            WHERE a.k > {last_base} AND a.score >= {pii.THRESHOLD}
              AND NOT EXISTS (SELECT 1 FROM scored AS b WHERE b.r = a.r AND b.k <= {last_base} AND b.s < a.e AND a.s < b.e)),
        found AS (
            SELECT r, {count}, {joined} AS spans,
                   string_agg({names}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k <= {last_base}) AS base,
                   string_agg(score::VARCHAR, ',' ORDER BY s, k) AS scores
            FROM kept GROUP BY r)
        SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in pii.BASE)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
        FROM d LEFT JOIN found USING (r)
    """


def _clusters() -> str:
    """The rounds of clustering, one after the other."""
    doubles = lambda c: f"{c}::DOUBLE[]"
    distance = f"(list_inner_product({doubles('v')}, {doubles('v')}) - 2 * list_inner_product({doubles('v')}, {doubles('c')}) + list_inner_product({doubles('c')}, {doubles('c')}))::BIGINT"
    parts = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({vafile.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {vafile.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS n, v AS c
            FROM (SELECT v, sha256(concat('2:', vec_id)) AS h FROM v ORDER BY h, v LIMIT {vafile.K}))""",
    ]
    nearest = lambda i: f"""a{i} AS MATERIALIZED (
            SELECT r, min(struct_pack(d := {distance}, n := n)) AS b FROM v, c{i} GROUP BY r)"""  # noqa: E731
    for i in range(vafile.ROUNDS):
        parts.append(nearest(i))
        parts.append(f"""c{i + 1} AS MATERIALIZED (
            SELECT n, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
                SELECT n, list(q ORDER BY i) AS m FROM (
                    SELECT n, i, (s - ((s % k) + k) % k) // k AS q FROM (
                        SELECT b.n AS n, i, sum(x)::BIGINT AS s, count(*) AS k
                        FROM (SELECT b, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i} JOIN v USING (r)) GROUP BY 1, 2))
                GROUP BY n) USING (n))""")
    parts.append(nearest(vafile.ROUNDS))
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, b.n::INTEGER AS cluster, b.d AS distance,
               (sum(b.d) OVER (PARTITION BY b.n))::BIGINT AS cluster_inertia, (sum(b.d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{vafile.ROUNDS} JOIN v USING (r) JOIN c{vafile.ROUNDS} ON b.n = c{vafile.ROUNDS}.n
    """


def _importance() -> str:
    """Checksums byte by byte over the distinct features, then the formulas as they stand."""
    buckets = importance.BUCKETS
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    table = f"list_transform(range(256), lambda b: list_reduce([b::BIGINT, 1, 1, 1, 1, 1, 1, 1, 1], lambda a, z: {step}))"
    letters = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({letters}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    grams = lambda name, table: f"""{name}w AS (SELECT row_number() OVER () AS r, {words} AS w{", doc_id" if name == "d" else ""} FROM {table}),
        {name}f AS (
            SELECT r, unnest(w) AS f FROM {name}w
            UNION ALL SELECT r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM {name}w)"""  # noqa: E731
    return rf"""
        WITH {grams("d", "documents")}, {grams("b", "benchmark")},
        crc AS MATERIALIZED (SELECT {table} AS t),
        feature AS MATERIALIZED (SELECT f, string_split(regexp_replace(hex(encode(f)), '(..)', '\1,', 'g'), ',') AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)),
        bucket AS MATERIALIZED (
            SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(x[1:len(x) - 1], lambda h: ('0x' || h)::BIGINT)),
                                      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % {buckets} AS k
            FROM feature, crc),
        dk AS MATERIALIZED (SELECT r, k FROM df JOIN bucket USING (f)),
        bk AS MATERIALIZED (SELECT k FROM bf JOIN bucket USING (f)),
        s AS (SELECT k, count(*) AS s FROM dk GROUP BY k), t AS (SELECT k, count(*) AS t FROM bk GROUP BY k),
        n AS (SELECT (SELECT count(*) FROM dk) AS s_all, (SELECT count(*) FROM bk) AS t_all),
        gain AS (
            SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {buckets})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + {buckets})::DOUBLE)))::BIGINT AS g
            FROM range({buckets}) AS every(k) LEFT JOIN s USING (k) LEFT JOIN t USING (k), n),
        weighed AS (SELECT r, count(*) AS n_features, sum(g) AS total FROM dk JOIN gain USING (k) GROUP BY r),
        scored AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
                   coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
                   floor(-1000 * ln(-ln((('0x' || sha256(concat('{importance.SEED}:', doc_id))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS draw
            FROM dw LEFT JOIN weighed USING (r)),
        placed AS (
            SELECT *, weight + draw AS score, n_words >= {importance.MIN_WORDS} AS able,
                   row_number() OVER (PARTITION BY n_words >= {importance.MIN_WORDS} ORDER BY weight + draw DESC, doc_id NULLS LAST, weight, n_features) AS place
            FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN able AND place <= (SELECT {importance.PERCENT} * count(*) // 100 FROM placed WHERE able) THEN place END AS rank
        FROM placed
    """


ORACLE_SQL: dict[str, str] = {
    "op11_pii": _pii(),
    "op12_centroid_clusters": _clusters(),
    "op13_importance_resampling": _importance(),
}
