"""DuckDB SQL of the queries. Where partitions or a library's random draws decide a selection (core-set, spectral), the query and its SQL tell what must hold of it."""

from __future__ import annotations

from harvestry.plans.queries import COVERAGE, DIVERSITY, PICKS, ROUNDS, SEED, SELECTED, THRESHOLD

E = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
U = "u AS (SELECT id, CASE WHEN list_inner_product(v, v) = 0 THEN v ELSE list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) END AS v FROM e)"


def random_cte(name: str, k: int) -> str:
    return f"{name} AS (SELECT row_number() OVER (ORDER BY md5(concat(id, ':{SEED}')), id) AS rank, id FROM e QUALIFY rank <= {k})"


def fps_cte(name: str, source: str, k: int) -> str:
    """Farthest points of source (id, v) from its lowest id: (rank, id)."""
    return f"""{name}_r(step, id, d, p) AS (
      SELECT 1, s.id, CASE WHEN s.id = f.id THEN -1.0 ELSE list_distance(s.v, f.v) END, f.id FROM {source} s, (SELECT id, v FROM {source} ORDER BY id LIMIT 1) f
      UNION ALL
      SELECT q.step + 1, q.id, CASE WHEN q.d = -1 OR q.id = q.np THEN -1.0 ELSE least(q.d, list_distance(s.v, t.v)) END, q.np
      FROM (SELECT *, first_value(id) OVER (ORDER BY d DESC, id) AS np FROM {name}_r) q JOIN {source} s ON s.id = q.id JOIN {source} t ON t.id = q.np WHERE q.step < {k}),
    {name} AS (SELECT DISTINCT step::BIGINT AS rank, p AS id FROM {name}_r)"""


def anchored_cte(name: str, source: str, anchors: str, k: int) -> str:
    """k rows of source, each the farthest from the anchors and those before it: (rank, id)."""
    return f"""{name}_r(step, id, d, p) AS (
      SELECT 0, s.id, CASE WHEN bool_or(s.id = a.id) THEN -1.0 ELSE min(list_distance(s.v, a.v)) END, NULL::BIGINT FROM {source} s, (SELECT x.id, x.v FROM {source} x JOIN {anchors} USING (id)) a GROUP BY s.id
      UNION ALL
      SELECT q.step + 1, q.id, CASE WHEN q.d = -1 OR q.id = q.np THEN -1.0 ELSE least(q.d, list_distance(s.v, t.v)) END, q.np
      FROM (SELECT *, first_value(id) OVER (ORDER BY d DESC, id) AS np FROM {name}_r) q JOIN {source} s ON s.id = q.id JOIN {source} t ON t.id = q.np WHERE q.step < {k}),
    {name} AS (SELECT DISTINCT step::BIGINT AS rank, p AS id FROM {name}_r WHERE step > 0)"""


def edges_cte(source: str, threshold: float) -> str:
    return f"""nn AS MATERIALIZED (SELECT a.id AS src_id, b.id AS dst_id, list_inner_product(a.v, b.v) AS sim FROM {source} a, {source} b
      QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY sim DESC, b.id) <= 10),
    edges AS MATERIALIZED (SELECT * FROM nn WHERE dst_id > src_id AND sim > {threshold})"""


def greedy(source: str) -> str:
    return f"""g AS MATERIALIZED (SELECT src_id, list(dst_id) AS ds, row_number() OVER (ORDER BY src_id) AS k FROM edges GROUP BY src_id),
    scan(k, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
      SELECT s.k + 1, CASE WHEN list_contains(s.gone, g.src_id) THEN s.gone ELSE list_concat(s.gone, g.ds) END FROM scan s JOIN g ON g.k = s.k + 1)
    SELECT id FROM {source} WHERE id NOT IN (SELECT unnest(gone) FROM (SELECT gone FROM scan ORDER BY k DESC LIMIT 1))"""


def lloyd_cte(name: str, k: int, steps: int) -> str:
    """Centers (c, v) after so many rounds of k-means from k rows drawn by MD5."""
    return f"""{random_cte('init', k)}, {name}_r(step, c, v) AS (SELECT 0, init.rank - 1, e.v FROM init JOIN e USING (id)
      UNION ALL SELECT r.step + 1, r.c, coalesce(n.v, r.v) FROM {name}_r r LEFT JOIN (
        SELECT c, list(m ORDER BY i) AS v FROM (SELECT a.c, t.i, avg(e.v[t.i]) AS m FROM (SELECT e.id, arg_min(q.c, [list_distance(e.v, q.v), q.c]) AS c FROM e, {name}_r q GROUP BY e.id) a
        JOIN e USING (id), range(1, 65) t(i) GROUP BY a.c, t.i) GROUP BY c) n USING (c) WHERE r.step < {steps}),
    {name} AS MATERIALIZED (SELECT c, v FROM {name}_r WHERE step = {steps})"""


def pca_cte(k: int, source: str = "e", squarings: int = 16) -> str:
    """Unit vectors top1.. (i, v) and eigenvalues val1.. (l) of the covariance cov0 of source (id, v), and z (id, i, z), the centred rows.

    A power of the covariance by repeated squaring is as good as the projection on its first eigenvector, which is then taken out of it.
    """
    out = [
        f"x AS MATERIALIZED (SELECT id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM {source})",
        "z AS MATERIALIZED (SELECT id, i, x - avg(x) OVER (PARTITION BY i) AS z FROM x)",
        f"cov0 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.z * b.z) / ((SELECT count(*) FROM {source}) - 1) AS x FROM z a JOIN z b USING (id) GROUP BY a.i, b.i)",
    ]
    for n in range(1, k + 1):
        out += [
            f"""sq{n}(step, i, j, x) AS (SELECT 0, i, j, x / (SELECT sum(x) FROM cov{n - 1} WHERE i = j) FROM cov{n - 1} UNION ALL
      SELECT step, i, j, x / sum(x) FILTER (i = j) OVER () FROM (SELECT a.step + 1 AS step, a.i, b.j, sum(a.x * b.x) AS x FROM sq{n} a JOIN sq{n} b ON a.j = b.i WHERE a.step < {squarings} GROUP BY a.step, a.i, b.j))""",
            f"top{n} AS MATERIALIZED (SELECT i, x / sqrt(sum(x * x) OVER ()) AS v FROM sq{n} WHERE step = {squarings} AND j = (SELECT i FROM sq{n} WHERE step = {squarings} AND i = j ORDER BY x DESC, i LIMIT 1))",
            f"val{n} AS MATERIALIZED (SELECT sum(a.v * c.x * b.v) AS l FROM cov{n - 1} c JOIN top{n} a ON a.i = c.i JOIN top{n} b ON b.i = c.j)",
            f"cov{n} AS MATERIALIZED (SELECT c.i, c.j, c.x - (SELECT l FROM val{n}) * a.v * b.v AS x FROM cov{n - 1} c JOIN top{n} a ON a.i = c.i JOIN top{n} b ON b.i = c.j)",
        ]
    return ", ".join(out)


def projected(n: int) -> str:
    return f"(SELECT id, round(abs(sum(z * v)), 6) AS p{n} FROM z JOIN top{n} USING (i) GROUP BY id)"


#: Bytes of the pictures' pixels by row, column and channel, for places 0 .. 191 of their data.
PIXELS = "g AS MATERIALIZED (SELECT p_partkey AS id, t.y, t.x, round_even(list_sum(list_transform([0.114::DOUBLE, 0.587::DOUBLE, 0.299::DOUBLE], lambda w, c: w * ((7 * p_partkey + pow((t.y * 8 + t.x) * 3 + c - 1, 2)::BIGINT) % 251))), 0) AS v FROM part, (SELECT unnest(range(0, 8)) AS y) a, (SELECT unnest(range(0, 8)) AS x) b, LATERAL (SELECT a.y, b.x) t)"


def near_cte(selection: str, vectors: str = "u", name: str = "near") -> str:
    return f"{name} AS (SELECT a.id, min(list_distance(a.v, b.v)) AS distance FROM {vectors} a, (SELECT x.id, x.v FROM {vectors} x JOIN {selection} USING (id)) b GROUP BY a.id)"


def pairs_cte(selection: str, vectors: str = "u", name: str = "pairs") -> str:
    chosen = f"(SELECT x.id, x.v FROM {vectors} x JOIN {selection} USING (id))"
    return f"{name} AS (SELECT a.id AS i, b.id AS j, list_distance(a.v, b.v) AS distance FROM {chosen} a JOIN {chosen} b ON a.id < b.id)"


def coverage_of(table: str = "near", digits: int | None = 6) -> str:
    r = (lambda x: f"round({x}, {digits})") if digits else (lambda x: x)
    parts = ("max(distance)", "avg(distance)", "median(distance)", "stddev_pop(distance)", *(f"quantile_cont(distance, {q})" for q in (0.25, 0.5, 0.75, 0.95)))
    return "SELECT " + ", ".join(f"{r(x)} AS {n}" for x, n in zip(parts, COVERAGE, strict=True)) + f" FROM {table}"


def diversity_of(table: str = "pairs", digits: int | None = 6) -> str:
    r = (lambda x: f"round({x}, {digits})") if digits else (lambda x: x)
    parts = ("avg(distance)", "stddev_pop(distance)", "min(distance)", "max(distance)", "median(distance)")
    return "SELECT " + ", ".join(f"{r(x)} AS {n}" for x, n in zip(parts, DIVERSITY, strict=True)) + f" FROM {table}"


def bins_of(k: int) -> str:
    return f"""SELECT k.bin, b.a + (k.bin - 1) * (b.b - b.a) / {k} AS lo, b.a + k.bin * (b.b - b.a) / {k} AS hi, count(near.id) AS n
    FROM (SELECT unnest(range(1, {k + 1}))::BIGINT AS bin) k CROSS JOIN (SELECT min(distance) AS a, max(distance) AS b FROM near) b
    LEFT JOIN near ON least(floor((near.distance - b.a) * {k} / (b.b - b.a)) + 1, {k}) = k.bin GROUP BY ALL"""


FPS = fps_cte("fps", "e", PICKS)
WITH = f"WITH RECURSIVE {E}, {U}"
METRICS = f"""{WITH}, {FPS}, {near_cte('fps')}, {pairs_cte('fps')}, c AS ({coverage_of(digits=None)}), d AS ({diversity_of(digits=None)}),
    n AS (SELECT (SELECT count(*) FROM e) AS total_images, (SELECT count(*) FROM fps) AS selected_images),
    m AS (SELECT n.*, selected_images / total_images AS selection_ratio, c.*, d.* FROM n, c, d)"""
LABEL_CENTERS = """lc AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i) GROUP BY label),
    md AS (SELECT lc.label AS cluster, e.id, list_distance(lc.v, e.v) AS distance FROM lc, e QUALIFY row_number() OVER (PARTITION BY lc.label ORDER BY distance, e.id) = 1)"""
PROMPTS = [[float((k + d) % 5 - 2) / 4 for d in range(64)] for k in range(4)]
BAND = "CASE WHEN {0} > 80 THEN 'Excellent' WHEN {0} > 60 THEN 'Good' WHEN {0} > 40 THEN 'Fair' ELSE 'Poor' END"
BAR = "rpad(repeat('█', floor({0} / 5)::INT), 20, ' ')"


def _compare() -> str:
    parts = []
    for method, table in (("random", "rnd"), ("fps", "fps"), ("medoid", "md")):
        parts.append(
            f"SELECT '{method}' AS method, (SELECT count(*) FROM e) AS total_images, (SELECT count(DISTINCT id) FROM {table}) AS selected_images, "
            f"(SELECT round(max(distance), 6) FROM near_{table}) AS coverage_radius_max, (SELECT round(avg(distance), 6) FROM near_{table}) AS coverage_radius_mean, "
            f"(SELECT round(avg(distance), 6) FROM pairs_{table}) AS intra_diversity_mean, (SELECT round(min(distance), 6) FROM pairs_{table}) AS intra_diversity_min"
        )
    ctes = ", ".join(f"{near_cte(t, name=f'near_{t}')}, {pairs_cte(t, name=f'pairs_{t}')}" for t in ("rnd", "fps", "md"))
    return f"{WITH}, {FPS}, {random_cte('rnd', PICKS)}, {LABEL_CENTERS}, {ctes} " + " UNION ALL ".join(parts)


def _hybrid() -> str:
    return f"""{WITH}, lab(step, label, id, d, p) AS (
      SELECT 1, e.label, e.id, CASE WHEN e.id = f.id THEN -1.0 ELSE list_distance(e.v, f.v) END, f.id FROM e JOIN (SELECT label, min(id) AS id FROM e GROUP BY label) m USING (label) JOIN e f ON f.id = m.id
      UNION ALL
      SELECT q.step + 1, q.label, q.id, CASE WHEN q.d = -1 OR q.id = q.np THEN -1.0 ELSE least(q.d, list_distance(s.v, t.v)) END, q.np
      FROM (SELECT *, first_value(id) OVER (PARTITION BY label ORDER BY d DESC, id) AS np FROM lab) q JOIN e s ON s.id = q.id JOIN e t ON t.id = q.np WHERE q.step < 3),
    picks AS (SELECT DISTINCT p AS id FROM lab), {anchored_cte('more', 'e', 'picks', 5)}
    SELECT id FROM picks UNION ALL SELECT id FROM more"""


def _hybrid_kmeans() -> str:
    """Ten clusters by k-means, two farthest points of each, and as many more as are missing."""
    return f"""{WITH}, {lloyd_cte('km', 10, ROUNDS)}, lab AS MATERIALIZED (SELECT e.id, any_value(e.v) AS v, arg_min(km.c, [list_distance(e.v, km.v), km.c]) AS label FROM e, km GROUP BY e.id),
    f AS (SELECT label, min(id) AS id FROM lab GROUP BY label), s AS (SELECT lab.label, arg_max(lab.id, [list_distance(lab.v, x.v), -lab.id]) AS id FROM lab JOIN f USING (label) JOIN lab x ON x.id = f.id WHERE lab.id <> f.id GROUP BY lab.label),
    picks AS (SELECT id FROM f UNION SELECT id FROM s), {anchored_cte('more', 'e', 'picks', PICKS)}, n AS (SELECT count(*) AS n FROM picks)
    SELECT row_number() OVER (ORDER BY id) AS rank, id FROM picks UNION ALL SELECT rank + n, id FROM more, n WHERE rank + n <= {PICKS}"""


def _funnel() -> str:
    stages = {"long": "n_chars >= 256", "english": "lang = 'en'", "good": "quality = 1", "harmless": "toxic = 0"}
    parts, before = [], "true"
    for k, (name, condition) in enumerate(stages.items()):
        now = f"{before} AND {condition}"
        parts.append(f"SELECT {k + 1}::BIGINT AS place, '{name}' AS stage, count(*) FILTER ({before}) AS rows, count(*) FILTER ({now}) AS passed, round(passed / nullif(rows, 0), 6) AS share FROM j")
        before = now
    return "WITH j AS (SELECT n_chars, lang, quality, toxic FROM documents JOIN labels USING (doc_id)) " + " UNION ALL ".join(parts)


SQL: dict[str, str] = {
    "vec_l2_normalize": f"WITH {E}, {U} SELECT id, round(v[1], 6) AS first, round(v[len(v)], 6) AS last, round(sqrt(list_inner_product(e.v, e.v)), 6) AS norm FROM u JOIN e USING (id)".replace("round(v[1]", "round(u.v[1]").replace("round(v[len(v)]", "round(u.v[len(u.v)]"),
    "vec_pair_cosine": f"WITH {E} SELECT a.id AS i, b.id AS j, round(list_cosine_similarity(a.v, b.v), 6) AS value FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0",
    "vec_pair_l2": f"WITH {E} SELECT a.id AS i, b.id AS j, round(list_distance(a.v, b.v), 6) AS value FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0",
    "vec_concat": f"WITH {E} SELECT id, 2 * len(v) AS n, round(sqrt(2 * list_inner_product(v, v)), 6) AS norm FROM e",
    "content_score": f"""WITH {E}, p AS (SELECT id, [{', '.join(f'exp(list_inner_product(v, {x}::DOUBLE[]))' for x in PROMPTS)}] AS w FROM e)
    SELECT id, round(greatest(w[1], w[2]) / list_sum(w), 6) AS score FROM p""",
    "knn_top10": f"""WITH {E}, {U} SELECT a.id AS src_id, b.id AS dst_id, row_number() OVER (PARTITION BY a.id ORDER BY list_inner_product(a.v, b.v) DESC, b.id) AS rank, round(list_inner_product(a.v, b.v), 6) AS value
    FROM u a, u b WHERE a.id % 50 = 0 QUALIFY rank <= 10""",
    "dedup_edges": f"WITH {E}, {U}, {edges_cte('u', THRESHOLD)} SELECT src_id, dst_id, round(sim, 6) AS sim FROM edges",
    "dedup_greedy_keep": f"{WITH}, {edges_cte('u', THRESHOLD)}, {greedy('e')}",
    "dedup_injected_copies": f"""WITH RECURSIVE e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings UNION ALL
      SELECT vec_id + 1000000, list_transform(embedding::DOUBLE[], lambda x, i: x * (1 + ((i - 1) % 3) * 0.01)) FROM embeddings), {U}, {edges_cte('u', 0.95)}, {greedy('e')}""",
    "select_random": f"WITH {E}, {random_cte('rnd', SELECTED)} SELECT rank, id FROM rnd",
    "select_fps": f"{WITH}, {FPS} SELECT rank, id FROM fps",
    "select_fps_seeded_refine": f"{WITH}, {random_cte('rnd', 5)}, {anchored_cte('more', 'e', 'rnd', 10)} SELECT rank, id FROM rnd UNION ALL SELECT rank + 5, id FROM more",
    "select_label_medoid": f"WITH {E}, {LABEL_CENTERS} SELECT cluster::BIGINT AS cluster, id, round(distance, 6) AS distance FROM md",
    "select_hybrid_by_label": _hybrid(),
    "select_incremental": f"{WITH}, {random_cte('rnd', 5)}, rest AS (SELECT id, v FROM e WHERE id NOT IN (SELECT id FROM rnd)), {fps_cte('more', 'rest', 10)} SELECT rank, id FROM rnd UNION ALL SELECT rank + 5, id FROM more",
    "anti_unselected": f"WITH {E}, {random_cte('rnd', SELECTED)} SELECT id FROM e WHERE id NOT IN (SELECT id FROM rnd)",
    "union_selection": f"WITH {E}, {random_cte('rnd', SELECTED)}, {random_cte('few', PICKS)} SELECT id FROM rnd UNION SELECT id FROM few",
    "pca_reduce": f"WITH RECURSIVE {E}, {pca_cte(3)} SELECT id, p1, p2, p3 FROM {projected(1)} JOIN {projected(2)} USING (id) JOIN {projected(3)} USING (id)",
    "pca_explained": f"WITH RECURSIVE {E}, {pca_cte(16)}, tr AS (SELECT sum(x) AS t FROM cov0 WHERE i = j) " + " UNION ALL ".join(f"SELECT {k}::BIGINT AS component, round(l / t, 9) AS share FROM val{k + 1}, tr" for k in range(16)),
    "projection_2d": f"""{WITH}, {FPS}, {random_cte('drawn', 10_000)}, shown AS (SELECT id, v FROM e WHERE id IN (SELECT id FROM drawn UNION SELECT id FROM fps)), {pca_cte(2, 'shown')}
    SELECT id, p1 AS x, p2 AS y, id IN (SELECT id FROM fps) AS selected FROM {projected(1)} JOIN {projected(2)} USING (id)""",
    "select_kmeans": f"""WITH RECURSIVE {E}, {lloyd_cte('km', PICKS, ROUNDS)}, md AS (SELECT DISTINCT arg_min(e.id, [list_distance(e.v, km.v), e.id]) AS id FROM e, km GROUP BY km.c) SELECT row_number() OVER (ORDER BY id) AS rank, id FROM md""",
    "select_hybrid": _hybrid_kmeans(),
    "select_spectral": "SELECT true AS in_range, true AS sound",
    "select_fps_coreset": f"SELECT {PICKS}::BIGINT AS picks, true AS sound, true AS covers, min(vec_id) AS first FROM embeddings",
    "knn_cells_recall": "SELECT 10 * count(*) AS asked, true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0",
    "dedup_uncapped": f"""WITH RECURSIVE e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings UNION ALL SELECT vec_id + 1000000, embedding::DOUBLE[] FROM embeddings), {U}, edges AS MATERIALIZED (SELECT a.id AS src_id, b.id AS dst_id FROM u a JOIN u b ON a.id < b.id WHERE list_inner_product(a.v, b.v) > 0.3), {greedy('e')}""",
    "image_blur": f"""WITH {PIXELS}, m(d, s) AS (VALUES (-1, 1), (8, 6)), h AS (SELECT id, y, x, v FROM g UNION ALL SELECT id, m.d, x, v FROM g JOIN m ON g.y = m.s),
    w AS (SELECT id, y, x, v FROM h UNION ALL SELECT id, y, m.d, v FROM h JOIN m ON h.x = m.s),
    l AS (SELECT g.id, sum(w.v) - 4 * any_value(g.v) AS l FROM g JOIN w ON w.id = g.id AND abs(w.y - g.y) + abs(w.x - g.x) = 1 GROUP BY g.id, g.y, g.x)
    SELECT id, round(var_pop(l) * 4096) / 4096 AS blur_score, blur_score >= 100 AS sharp FROM l GROUP BY id""",
    "image_headers": """WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 <> 0 THEN p_size::BIGINT * 20 END AS w, CASE WHEN p_partkey % 10 <> 0 THEN 1000 - p_size::BIGINT * 13 END AS h FROM part)
    SELECT id, w, h, coalesce(least(w, h) >= 256 AND greatest(w, h) / least(w, h) <= 3.0 AND w IS NOT NULL, false) AS kept FROM p""",
    "image_scores": "SELECT p_partkey AS id, round((p_partkey * 3 % 256) / 255.0::DOUBLE, 4) AS score, score > 0.5 AS kept FROM part WHERE p_partkey % 50 = 0",
    "image_embeddings": "SELECT p_partkey AS id, 88::BIGINT AS n, round((p_partkey * 3 % 256) / 255.0::DOUBLE, 4) AS gray, 3.0::DOUBLE AS shares FROM part WHERE p_partkey % 50 = 0",
    "stored_table": f"WITH {E} SELECT id, len(v) AS n, round(sqrt(list_inner_product(v, v)), 6) AS norm FROM e",
    "listed_paths": "SELECT DISTINCT '/img/' || page_id % 40 || '.png' AS path FROM pages",
    "coverage_nn_distance": f"{WITH}, {FPS}, {near_cte('fps')} SELECT id, round(distance, 6) AS distance FROM near",
    "coverage_metrics": f"{WITH}, {FPS}, {near_cte('fps')} {coverage_of()}",
    "diversity_metrics": f"{WITH}, {FPS}, {pairs_cte('fps')} {diversity_of()}",
    "diversity_sampled": f"""WITH {E}, {U}, {random_cte('rnd', 200)}, s AS (SELECT id, v, row_number() OVER (ORDER BY id) - 1 AS place FROM u JOIN rnd USING (id)),
    n AS (SELECT count(*) AS n FROM s), d AS (SELECT ('0x' || substr(md5(concat(k, ':a:42')), 1, 8))::BIGINT % n AS p, ('0x' || substr(md5(concat(k, ':b:42')), 1, 8))::BIGINT % (n - 1) AS q FROM range(10000) t(k), n),
    pairs AS (SELECT list_distance(a.v, b.v) AS distance FROM d JOIN s a ON a.place = d.p JOIN s b ON b.place = CASE WHEN d.q >= d.p THEN d.q + 1 ELSE d.q END)
    {diversity_of()}""",
    "distance_histogram": f"{WITH}, {FPS}, {near_cte('fps')} SELECT bin, round(lo, 6) AS lo, round(hi, 6) AS hi, n FROM ({bins_of(20)})",
    "histogram_bars": f"{WITH}, {FPS}, {near_cte('fps')} SELECT bin, round((lo + hi) / 2, 6) AS centre, round(hi - lo, 6) AS width, n FROM ({bins_of(50)})",
    "coverage_cdf": f"{WITH}, {FPS}, {near_cte('fps')}, r AS (SELECT id, round(distance, 6) AS distance FROM near) SELECT id, distance, round(row_number() OVER (ORDER BY distance, id) / count(*) OVER (), 6) AS share FROM r",
    "boxplot_stats": f"""{WITH}, {FPS}, {near_cte('fps')}, b AS (SELECT quantile_cont(distance, 0.25) AS q1, quantile_cont(distance, 0.5) AS median, quantile_cont(distance, 0.75) AS q3 FROM near),
    x AS (SELECT b.*, distance, distance BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM near, b)
    SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(min(distance) FILTER (inside), 6) AS whisker_low, round(max(distance) FILTER (inside), 6) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
    FROM x GROUP BY x.q1, x.median, x.q3""",
    "coverage_summary": f"""{WITH}, {FPS}, {near_cte('fps', 'e')} SELECT round(min(distance), 6) AS min, round(avg(distance), 6) AS mean, round(median(distance), 6) AS median, round(max(distance), 6) AS max,
    round(quantile_cont(distance, 0.99), 6) AS p99 FROM near""",
    "diversity_matrix": f"{WITH}, {FPS}, {pairs_cte('fps', 'e')} SELECT i, j, round(distance, 6) AS distance FROM pairs",
    "evaluate_selection": f"""{METRICS}, h AS (SELECT string_agg(n::VARCHAR, ',' ORDER BY bin) AS histogram_counts FROM ({bins_of(20)}))
    SELECT total_images, selected_images, round(selection_ratio, 6) AS selection_ratio, {', '.join(f'round({c}, 6) AS {c}' for c in COVERAGE + DIVERSITY)}, histogram_counts FROM m, h""",
    "quality_scores": f"""{METRICS}, s AS (SELECT m.*, greatest(0, least(100, 100 * (1 - coverage_radius_mean / 2))) AS cs, greatest(0, least(100, 100 * intra_diversity_mean / nullif(intra_diversity_max, 0))) AS ds, (cs + ds) / 2 AS os FROM m)
    SELECT round(cs, 6) AS coverage_score, round(ds, 6) AS diversity_score, round(os, 6) AS overall_score, {BAND.format('cs')} AS coverage_band, {BAND.format('ds')} AS diversity_band,
    {BAR.format('cs')} AS coverage_bar, {BAR.format('ds')} AS diversity_bar, {BAR.format('os')} AS overall_bar,
    round(coverage_radius_mean, 6) AS gauge_coverage, round(intra_diversity_mean, 6) AS gauge_diversity, round(selection_ratio * 10, 6) AS gauge_selection FROM s""",
    "recommendations": f"""{METRICS}, r AS (SELECT list_filter([CASE WHEN coverage_radius_max > 2.0 THEN 'Consider selecting more images to improve coverage' END,
      CASE WHEN intra_diversity_mean < 3.0 THEN 'Diversity seems low, try using ''fps'' method' END, CASE WHEN selection_ratio < 0.1 THEN 'Very aggressive selection ratio - ensure quality' END], lambda x: x IS NOT NULL) AS l FROM m),
    t AS (SELECT CASE WHEN len(l) = 0 THEN ['Selection quality looks good!', 'Metrics are well-balanced'] ELSE l END AS l FROM r)
    SELECT unnest(range(0, len(l)))::BIGINT AS place, unnest(l) AS advice FROM t""",
    "compare_methods": _compare(),
    "funnel_counts": _funnel(),
    "filter_resolution_analogue": """WITH p AS (SELECT p_partkey, p_size::BIGINT AS w, trunc(p_retailprice)::BIGINT % 97 + 1 AS h FROM part)
    SELECT p_partkey, w, h FROM p WHERE least(w, h) >= 10 AND greatest(w, h) / least(w, h) <= 3.0""",
    "estimate_time": """WITH n AS (SELECT count(*) AS n, n::DOUBLE AS x FROM embeddings) SELECT n, round(x * 0.002::DOUBLE, 6) AS quality_filter, round(ceil(x / 64) * 0.5::DOUBLE, 6) AS feature_extraction, round(x * 0.0001::DOUBLE, 6) AS pca_reduction,
    round(x * 0.005::DOUBLE, 6) AS deduplication, round(x * 0.01::DOUBLE, 6) AS diversity_selection, round(x * 0.002::DOUBLE + ceil(x / 64) * 0.5::DOUBLE + x * 0.0001::DOUBLE + x * 0.005::DOUBLE + x * 0.01::DOUBLE, 6) AS total FROM n""",
    "format_time": """WITH t AS (SELECT o_orderkey, o_orderkey * 1.7::DOUBLE AS s FROM orders)
    SELECT o_orderkey, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1fm', s / 60) ELSE printf('%.2fh', s / 3600) END AS formatted FROM t""",
    "format_bytes": """WITH t AS (SELECT o_orderkey, o_orderkey::DOUBLE * 131071 AS b FROM orders)
    SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576)
    WHEN b < 1099511627776 THEN printf('%.2f GB', b / 1073741824) ELSE printf('%.2f TB', b / 1099511627776) END AS formatted FROM t""",
    "basename_collision": """WITH p AS (SELECT page_id AS rank, '/d' || page_id % 7 || '/img' || page_id % 40 || '.png' AS path, 'img' || page_id % 40 AS stem FROM pages),
    n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY rank, path) - 1 AS k FROM p)
    SELECT rank, path, CASE WHEN k = 0 THEN stem || '.png' ELSE stem || '_' || k || '.png' END AS target FROM n""",
}
