"""SQL that defines the result of each registered query, for a second engine to run.

Where an operator avoids a product of rows, the SQL here writes that product out.
"""

from __future__ import annotations

import json

from tagweave import fixed_values as fixed
from tagweave.plans import catalog
from tagweave.sources import images

SCALE, BIAS = "10.0", "2.5"


def _u(*keys: str) -> str:
    parts = " || ':' || ".join([f"'{fixed.SEED}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST(('0x' || substr(md5({parts}), 1, 13)) AS BIGINT) / 4503599627370496.0)"


def _split(key: str) -> str:
    return (
        f"CASE WHEN {_u(key)} < {fixed.TRAIN_SHARE} THEN 'train' "
        f"WHEN {_u(key)} < {fixed.TRAIN_AND_VALID_SHARE} THEN 'valid' ELSE 'test' END"
    )


def _sigmoid(x: str) -> str:
    return f"(1.0 / (1.0 + exp(-({x}))))"


def _unit(vector: str) -> str:
    return f"list_transform({vector}, lambda x: x / sqrt(list_dot_product({vector}, {vector})))"


# --- training, one row of state per step ------------------------------------------------------


def _turned(matrix: str, width: str) -> str:
    return f"list_transform(range(1, {width} + 1), lambda k: list_transform({matrix}, lambda row: row[k]))"


def _each_cell(matrices: list[str], value: str) -> str:
    """A matrix of ``value``, where e[1], e[2] ... are the cells of the matrices."""
    rows = ", ".join(f"q[{i}]" for i in range(1, len(matrices) + 1))
    return f"list_transform(list_zip({', '.join(matrices)}), lambda q: list_transform(list_zip({rows}), lambda e: {value}))"


def _step_sql() -> str:
    """The state after a step from the one before: gradients of a batch and an AdamW update, written out."""
    sign, rate = "CASE WHEN i = j THEN 1.0 ELSE -1.0 END", fixed.LEARNING_RATE

    def through(rows: str, head: str) -> str:
        return f"list_transform({rows}, lambda x: list_transform({head}, lambda w: list_dot_product(w, x)))"

    def slopes(factors: str, others: str) -> str:
        return f"list_transform({factors}, lambda s: list_transform({_turned(others, 'd')}, lambda c: list_dot_product(c, s)))"

    def behind_norm(slope: str, unit: str, raw: str) -> str:
        cell = "(e[1] - list_dot_product(q[1], q[2]) * e[2]) / sqrt(list_dot_product(q[3], q[3]))"
        return f"list_transform(list_zip({slope}, {unit}, {raw}), lambda q: list_transform(list_zip(q[1], q[2]), lambda e: {cell}))"

    def gradient(slope: str, turned_rows: str) -> str:
        return f"list_transform({_turned(slope, 'd')}, lambda g: list_transform({turned_rows}, lambda c: list_dot_product(c, g)))"

    def update(side: str) -> str:
        mean, square = "e[2] / (1.0 - pow(0.9, now))", "e[3] / (1.0 - pow(0.999, now))"
        return _each_cell([f"w{side}", f"m{side}2", f"v{side}2"], f"e[1] * (1.0 - {rate} * 0.01) - {rate} * ({mean}) / (sqrt({square}) + 1e-8)")

    log_sigmoid = "least(x, 0.0) - ln(1.0 + exp(-abs(x)))"
    logit = f"{sign} * ({SCALE} * list_dot_product(u, v) - {BIAS})"
    steps = [
        f"f.*, b.t AS now, b.epoch AS of_epoch, d, n, xt, yt, {through('xs', 'wi')} AS pi, {through('ys', 'wt')} AS pt",
        f"*, list_transform(pi, lambda p: {_unit('p')}) AS ui, list_transform(pt, lambda p: {_unit('p')}) AS ut",
        f"*, list_transform(ui, lambda u, i: list_transform(ut, lambda v, j: {logit})) AS z",
        f"*, list_avg(flatten(list_transform(z, lambda row: list_transform(row, lambda x: -({log_sigmoid}))))) AS now_loss, "
        f"list_transform(z, lambda row, i: list_transform(row, lambda x, j: -({sign}) / (1.0 + exp(x)) * {SCALE} / (n * n))) AS slope",
        f"*, {slopes('slope', 'ut')} AS gi, {slopes(_turned('slope', 'n'), 'ui')} AS gt",
        f"*, {behind_norm('gi', 'ui', 'pi')} AS bi, {behind_norm('gt', 'ut', 'pt')} AS bt",
        f"*, {gradient('bi', 'xt')} AS di, {gradient('bt', 'yt')} AS dt",
        "*, " + ", ".join(
            f"{_each_cell([m + side, 'd' + side], f'{keep} * e[1] + (1.0 - {keep}) * {new}')} AS {m}{side}2"
            for side in "it" for m, keep, new in (("m", 0.9, "e[2]"), ("v", 0.999, "e[2] * e[2]"))
        ),
        f"now, of_epoch, now_loss, {update('i')}, {update('t')}, mi2, mt2, vi2, vt2",
    ]
    source = "fit f JOIN step_inputs b ON b.t = f.t + 1"
    for step in steps:
        source = f"(SELECT {step} FROM {source})"
    return source[1:-1]


def _training_ctes() -> dict[str, tuple[tuple[str, ...], str]]:
    square = "list_transform(range(1, d + 1), lambda r: list_transform(range(1, d + 1), lambda c: {} :: DOUBLE))"
    eye, zero = square.format("(CASE WHEN r = c THEN 1.0 ELSE 0.0 END)"), square.format("0.0")
    return {
        "epochs": (
            ("triplets",),
            "SELECT epoch, image_id, img, pos, (row_number() OVER (PARTITION BY epoch ORDER BY "
            + _u("epoch", "image_id")
            + f", image_id) - 1) // {fixed.BATCH_SIZE} AS batch_id FROM triplets, range(1, {fixed.NUM_EPOCHS + 1}) r(epoch) "
            "WHERE split = 'train'",
        ),
        "step_rows": (
            ("epochs",),
            "SELECT row_number() OVER (ORDER BY epoch, batch_id) AS t, epoch, batch_id, len(first(img)) AS d, count(*) AS n, "
            "list(img ORDER BY image_id) AS xs, list(pos ORDER BY image_id) AS ys FROM epochs GROUP BY epoch, batch_id",
        ),
        "step_inputs": (("step_rows",), f"SELECT *, {_turned('xs', 'd')} AS xt, {_turned('ys', 'd')} AS yt FROM step_rows"),
        "fit": (
            ("step_inputs",),
            "SELECT 0 :: BIGINT AS t, 0 :: BIGINT AS epoch, 0.0 :: DOUBLE AS loss, "
            f"{eye} AS wi, {eye} AS wt, {zero} AS mi, {zero} AS mt, {zero} AS vi, {zero} AS vt FROM (SELECT max(d) AS d FROM step_inputs) "
            f"UNION ALL {_step_sql()}",
        ),
        "heads": (("fit",), "SELECT wi, wt FROM fit ORDER BY t DESC LIMIT 1"),
    }


# --- shared common table expressions, each named once and listed with what it needs -----------

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "captions": (
        (),
        "SELECT (doc_id // 4) * 10 + CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 "
        "WHEN 'es' THEN 3 ELSE 4 END AS image_id, doc_id AS cap_no, text AS caption FROM documents",
    ),
    "images": (
        ("captions",),
        "SELECT DISTINCT image_id AS id, 'IMG_' || image_id || '.jpg' AS file_name FROM captions",
    ),
    "outcomes": (
        ("captions",),
        "SELECT image_id, max(coalesce(toxic, 0)) = 0 AS ok FROM captions "
        "LEFT JOIN labels ON labels.doc_id = captions.cap_no GROUP BY image_id",
    ),
    "eligible": (
        ("captions",),
        f"SELECT image_id, count(*) AS n_captions FROM captions GROUP BY image_id HAVING count(*) >= {fixed.MIN_CAPTIONS}",
    ),
    "loaded": (
        ("captions", "eligible", "outcomes"),
        "SELECT *, sha256(caption) AS digest FROM captions WHERE image_id IN (SELECT image_id FROM eligible) "
        "AND image_id IN (SELECT image_id FROM outcomes WHERE ok)",
    ),
    "pool": (
        ("loaded",),
        "SELECT digest, row_number() OVER (ORDER BY digest, image_id, cap_no) - 1 AS pos FROM loaded",
    ),
    "own": (("loaded",), "SELECT DISTINCT image_id, digest FROM loaded"),
    "admissible": (
        ("pool", "own"),
        "SELECT i.image_id, p.digest, row_number() OVER (PARTITION BY i.image_id ORDER BY p.pos) - 1 AS r, "
        "count(*) OVER (PARTITION BY i.image_id) AS n FROM (SELECT DISTINCT image_id FROM own) i, pool p "
        "WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.image_id = i.image_id AND o.digest = p.digest)",
    ),
    "negatives": (
        ("admissible", "own", "loaded"),
        "SELECT i.image_id, t.caption AS text_negative FROM (SELECT DISTINCT image_id FROM own) i "
        "LEFT JOIN (SELECT * FROM admissible WHERE r = CAST(floor(" + _u("'negative'", "image_id") + " * n) AS BIGINT)) a "
        "ON a.image_id = i.image_id "
        "LEFT JOIN (SELECT digest, any_value(caption) AS caption FROM loaded GROUP BY digest) t ON t.digest = a.digest",
    ),
    "pairs": (
        ("loaded", "negatives"),
        "SELECT CAST(f.image_id AS VARCHAR) AS image_id, '/images/IMG_' || f.image_id || '.jpg' AS image_path, "
        "text_positive, text_negative, 'coco' AS category, " + _split("f.image_id") + " AS split FROM "
        "(SELECT image_id, arg_min(caption, cap_no) AS text_positive FROM loaded GROUP BY image_id) f "
        "LEFT JOIN negatives n ON n.image_id = f.image_id",
    ),
    "vec": (
        (),
        "SELECT vec_id AS image_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings",
    ),
    "around": (
        ("vec",),
        "SELECT v.image_id, v.e, a.e AS nxt, b.e AS prv FROM vec v "
        "LEFT JOIN vec a ON a.image_id = (v.image_id + 1) % (SELECT max(image_id) + 1 FROM vec) "
        "LEFT JOIN vec b ON b.image_id = (v.image_id - 1 + (SELECT max(image_id) + 1 FROM vec)) "
        "% (SELECT max(image_id) + 1 FROM vec)",
    ),
    "mixed": (
        ("around",),
        "SELECT image_id, e AS img, list_transform(list_zip(e, coalesce(nxt, e)), lambda p: p[1] + p[2]) AS pos0, "
        "list_transform(list_zip(coalesce(prv, e), e), lambda p: p[1] + p[2]) AS neg0 FROM around",
    ),
    "triplets": (
        ("mixed",),
        "SELECT " + _split("image_id") + f" AS split, image_id, img, {_unit('pos0')} AS pos, {_unit('neg0')} AS neg FROM mixed",
    ),
    **_training_ctes(),
    "phase_rows": (
        ("triplets", "heads"),
        "SELECT 'baseline' AS phase, * FROM triplets UNION ALL SELECT 'final', split, image_id, "
        + ", ".join(f"{_unit('p_' + c)} AS {c}" for c in ("img", "pos", "neg"))
        + " FROM (SELECT split, image_id, "
        + ", ".join(f"list_transform({w}, lambda w: list_dot_product(w, {c})) AS p_{c}" for c, w in (("img", "wi"), ("pos", "wt"), ("neg", "wt")))
        + " FROM triplets, heads)",
    ),
    "seen": (
        ("fit", "triplets"),
        "SELECT epoch, image_id, list_transform(wi, lambda w: list_dot_product(w, img)) AS img0, "
        + _unit("list_transform(wt, lambda w: list_dot_product(w, pos))")
        + " AS pos, list_cosine_similarity(list_transform(wi, lambda w: list_dot_product(w, img)), list_transform(wt, lambda w: list_dot_product(w, pos))) > "
        "list_cosine_similarity(list_transform(wi, lambda w: list_dot_product(w, img)), list_transform(wt, lambda w: list_dot_product(w, neg))) AS win, "
        "img0 AS img FROM triplets, (SELECT epoch, arg_max(wi, t) AS wi, arg_max(wt, t) AS wt FROM fit WHERE t > 0 GROUP BY epoch) WHERE split = 'valid'",
    ),
    "nearest": (
        ("phase_rows",),
        "SELECT a.phase, a.split, a.image_id, arg_max(b.image_id, list_dot_product(a.img, b.pos)) AS best_id "
        "FROM phase_rows a JOIN phase_rows b ON a.phase = b.phase AND a.split = b.split GROUP BY ALL",
    ),
    "evaluated": (
        ("nearest", "phase_rows"),
        "SELECT * FROM (SELECT phase, split, avg(CAST(best_id = image_id AS DOUBLE)) AS recall_at_1 FROM nearest "
        "GROUP BY ALL) JOIN (SELECT phase, split, CASE WHEN split <> 'train' THEN "
        "avg(CAST(list_cosine_similarity(img, pos) > list_cosine_similarity(img, neg) AS DOUBLE)) END "
        "AS triplet_accuracy FROM phase_rows GROUP BY phase, split) USING (phase, split)",
    ),
    "metric_rows": (
        ("evaluated",),
        "SELECT * FROM (SELECT phase, split, 'recall_at_1' AS metric, recall_at_1 AS value FROM evaluated UNION ALL "
        "SELECT phase, split, 'triplet_accuracy', triplet_accuracy FROM evaluated) WHERE value IS NOT NULL",
    ),
    "cells": (("vec",), "SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM vec"),
    "sums": (("cells",), "SELECT label, i, avg(x) AS x FROM cells GROUP BY label, i"),
    "means": (("sums",), "SELECT label, list(x ORDER BY i) AS m FROM sums GROUP BY label"),
    "tags": (
        ("means",),
        "SELECT 'tag_' || label AS tag, label AS pos, "
        "list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS v FROM means",
    ),
    "scores": (
        ("vec", "tags"),
        "SELECT image_id, label, tag, pos, round("
        + _sigmoid(f"{SCALE} * list_dot_product(e, v) - {BIAS}")
        + f", {fixed.SCORE_DECIMALS}) AS score FROM vec, tags",
    ),
    "ranked": (
        ("scores",),
        "SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pos) AS rank, "
        f"max(score) OVER (PARTITION BY image_id) >= {fixed.TAG_SCORE_THRESHOLD} AS any_pass FROM scores",
    ),
    "selected": (
        ("ranked",),
        f"SELECT image_id, rank, tag, score FROM ranked WHERE CASE WHEN any_pass "
        f"THEN score >= {fixed.TAG_SCORE_THRESHOLD} ELSE rank <= {fixed.FALLBACK_TAGS} END",
    ),
    "named": (("selected",), "SELECT 'IMG_' || image_id || '.jpg' AS filename, rank, tag, score FROM selected"),
    "batched": (
        ("triplets",),
        "SELECT split, image_id, img, pos, (row_number() OVER (PARTITION BY split ORDER BY "
        + _u("split", "image_id")
        + f", image_id) - 1) // {fixed.BATCH_SIZE} AS batch_id FROM triplets",
    ),
    "epoch_losses": (("fit",), "SELECT epoch, avg(loss) AS loss, count(*) AS n_batches FROM fit WHERE t > 0 GROUP BY epoch"),
    "byte_counts": (
        (),
        "SELECT doc_id, bucket, count(*) AS n FROM (SELECT doc_id, CAST('0x' || b AS INTEGER) % 64 AS bucket FROM "
        "(SELECT doc_id, unnest(regexp_extract_all(hex(encode(text)), '..')) AS b FROM documents)) GROUP BY ALL",
    ),
    "doc_scores": (
        ("byte_counts", "tags"),
        "SELECT doc_id, tag, pos, round("
        + _sigmoid(f"{SCALE} * sum(n * v[bucket + 1]) / sqrt(sum(n * n)) - {BIAS}")
        + f", {fixed.SCORE_DECIMALS}) AS score FROM byte_counts, tags GROUP BY ALL",
    ),
    "log": (
        (),
        "SELECT user_id AS run_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS epoch, "
        "avg(CAST(value > 50 AS DOUBLE)) AS recall FROM events GROUP BY ALL",
    ),
    "versions": (
        (),
        "SELECT o_orderpriority AS model, CAST(o_orderkey AS VARCHAR) AS version, o_orderstatus AS status, "
        "md5(CAST(o_orderkey AS VARCHAR)) AS run_id FROM orders",
    ),
}


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    return "WITH RECURSIVE " + ", ".join(f"{n} AS {'' if n == 'fit' else 'MATERIALIZED '}({CTES[n][1]})" for n in order) + " " + body


def _override_sql() -> str:
    asked = (
        "asked AS (SELECT image_id, unnest([(label + 2) % 10, label % 10, (label + 1) % 10]) AS tag_no, "
        "unnest([0, 1, 2]) AS cand_pos, label FROM vec WHERE label < 5 UNION ALL "
        "SELECT image_id, tags.pos, tags.pos, label FROM vec, tags WHERE label >= 5), "
        "scored AS (SELECT a.image_id, a.label, s.tag, s.score, "
        "CASE WHEN a.label BETWEEN 4 AND 6 THEN 0.5 ELSE 0.3 END AS lim, "
        "row_number() OVER (PARTITION BY a.image_id ORDER BY s.score DESC, a.cand_pos) AS rank "
        "FROM asked a JOIN scores s ON s.image_id = a.image_id AND s.tag = 'tag_' || a.tag_no), "
        "passed AS (SELECT *, max(score) OVER (PARTITION BY image_id) >= lim AS any_pass FROM scored) "
    )
    head = _with("", "scores").rstrip()
    return head + ", " + asked + (
        "SELECT image_id, CAST(rank AS INTEGER) AS rank, tag, score FROM passed "
        "WHERE CASE WHEN any_pass THEN score >= lim ELSE rank <= 3 END"
    )


def _custom_sql() -> str:
    head = _with("", "scores").rstrip()
    return head + (
        ", asked AS (SELECT image_id, unnest([label % 10, (label + 3) % 10, (label + 6) % 10, (label + 9) % 10]) AS tag_no, "
        "unnest([0, 1, 2, 3]) AS cand_pos FROM vec) "
        "SELECT a.image_id, CAST(row_number() OVER (PARTITION BY a.image_id ORDER BY s.score DESC, a.cand_pos) AS INTEGER) "
        "AS rank, s.tag, s.score FROM asked a JOIN scores s ON s.image_id = a.image_id AND s.tag = 'tag_' || a.tag_no"
    )


_COUNTS = (
    "words AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS word FROM documents), "
    "counts AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket, "
    "count(*) AS n FROM words WHERE word <> '' GROUP BY ALL)"
)


def _many_sql() -> str:
    return (
        f"WITH {_COUNTS}, vec AS ({CTES['vec'][1]}), norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY 1), "
        "asked AS (SELECT image_id, e, (image_id * 7 + i) % (SELECT max(doc_id) + 1 FROM documents) AS doc_id, p FROM "
        "(SELECT image_id, e, unnest([0, 31, 77]) AS i, unnest([0, 1, 2]) AS p FROM vec)), "
        "scored AS (SELECT image_id, p, 'doc_' || a.doc_id AS tag, round("
        + _sigmoid(f"{SCALE} * sum(c.n * a.e[c.bucket + 1]) / any_value(norm) - {BIAS}")
        + f", {fixed.SCORE_DECIMALS}) AS score FROM asked a LEFT JOIN counts c USING (doc_id) LEFT JOIN norms USING (doc_id) "
        "GROUP BY image_id, p, a.doc_id UNION ALL SELECT image_id, 3, 'doc_none', NULL FROM vec) "
        "SELECT image_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY score DESC NULLS LAST, p) AS INTEGER) AS rank, "
        "tag, score FROM scored"
    )


def _gradient_sql() -> str:
    """The chain rule of the loss at identity heads, written out over cells."""
    unit = "list_transform({0}, lambda x: x / sqrt(list_dot_product({0}, {0})))"
    head = _with("", "batched").rstrip()
    return head + (
        ", rows AS (SELECT batch_id, image_id, img, pos AS txt, " + unit.format("img") + " AS iu, " + unit.format("pos") + " AS tu, "
        "sqrt(list_dot_product(img, img)) AS il, sqrt(list_dot_product(pos, pos)) AS tl, "
        "count(*) OVER (PARTITION BY batch_id) AS n FROM batched WHERE split = 'train'), "
        "pairs AS (SELECT a.image_id AS i, b.image_id AS j, a.iu, b.tu, a.n, a.batch_id, "
        "CASE WHEN a.image_id = b.image_id THEN 1.0 ELSE -1.0 END AS label, "
        f"{SCALE} * list_dot_product(a.iu, b.tu) - {BIAS} AS z FROM rows a JOIN rows b USING (batch_id)), "
        f"sloped AS (SELECT *, -label / (1.0 + exp(label * z)) * {SCALE} / (n * n) AS slope FROM pairs), "
        "dims AS (SELECT unnest(range(1, len(img) + 1)) AS d FROM (SELECT img FROM rows LIMIT 1)), "
        "att AS (SELECT 'image' AS head, i AS id, d, sum(slope * tu[d]) AS g FROM sloped, dims GROUP BY i, d "
        "UNION ALL SELECT 'text', j, d, sum(slope * iu[d]) FROM sloped, dims GROUP BY j, d), "
        "sides AS (SELECT 'image' AS head, image_id AS id, img AS v, iu AS u, il AS l FROM rows "
        "UNION ALL SELECT 'text', image_id, txt, tu, tl FROM rows), "
        "along AS (SELECT head, id, sum(g * u[d]) AS s FROM att JOIN sides USING (head, id) GROUP BY ALL), "
        "slopes AS (SELECT head, id, d, (g - s * u[d]) / l AS g, v FROM att JOIN sides USING (head, id) JOIN along USING (head, id)) "
        "SELECT head, CAST(s.d - 1 AS INTEGER) AS row, CAST(dims.d - 1 AS INTEGER) AS col, round(sum(g * v[dims.d]), 6) AS value "
        "FROM slopes s, dims GROUP BY head, s.d, dims.d UNION ALL "
        "SELECT 'loss', 0, 0, round(sum(loss), 6) FROM (SELECT batch_id, "
        "avg(-(least(label * z, 0.0) - ln(1.0 + exp(-abs(z))))) AS loss FROM pairs GROUP BY batch_id)"
    )


_NO_METRICS = (
    '\'{"inference_time_ms":null,"gpu_memory_allocated_mb":null,"gpu_memory_peak_mb":null,"gpu_utilization_pct":null}\''
)
_FILE = "'IMG_' || image_id || '.jpg'"
_PARAMS = {
    "base_model": "stored_vectors",
    "training_table": "training_image_text_pairs",
    "num_epochs": str(fixed.NUM_EPOCHS),
    "batch_size": str(fixed.BATCH_SIZE),
    "learning_rate": str(fixed.LEARNING_RATE),
    "trainable_layers": json.dumps(fixed.TRAINABLE_LAYERS),
    "loss_function": fixed.LOSS_NAME,
}
_SUMMARY = (
    f"{_FILE} AS filename, CAST(len(e) AS INTEGER) AS dims, round(sqrt(list_dot_product(e, e)), 6) AS norm, "
    "round(list_sum(e), 6) AS total"
)

SQL: dict[str, str] = {
    # sources
    "scan_captions": _with(
        f"SELECT image_id, {_FILE} AS file_name, caption FROM captions", "captions"
    ),
    "scan_images": "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents",
    "scan_split": _with("SELECT * FROM pairs WHERE split = 'train'", "pairs"),
    "scan_results": _with(
        f"SELECT num_tags, v.* FROM (SELECT image_id, CAST(count(*) AS INTEGER) AS num_tags FROM selected GROUP BY image_id) s "
        f"JOIN (SELECT image_id AS id, {_SUMMARY} FROM vec) v ON s.image_id = v.id",
        "selected",
    ).replace("num_tags, v.*", "num_tags, v.filename, v.dims, v.norm, v.total"),
    "typed_pairs": _with("SELECT * FROM pairs", "pairs"),
    "build_requests": "SELECT 'IMG_' || doc_id || '.jpg' AS filename, base64(encode(text)) AS image_base64, "
    f"'{json.dumps(fixed.DEFAULT_TAG_CANDIDATES, ensure_ascii=False)}' AS tag_candidates_json FROM documents",
    "load_with_placeholder": _with(
        "SELECT image_id, ok AS load_ok, CASE WHEN ok THEN CAST(octet_length(encode(first)) AS BIGINT) "
        f"ELSE {len(images.placeholder())} END AS n_bytes FROM outcomes JOIN "
        "(SELECT image_id, arg_min(caption, cap_no) AS first FROM captions GROUP BY image_id) USING (image_id)",
        "outcomes",
    ),
    "resume_ingest": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "ingest_outcomes": _with(
        "SELECT count(*) FILTER (WHERE ok) AS n_loaded, count(*) FILTER (WHERE NOT ok) AS n_failed, "
        "count(*) AS n_wanted FROM outcomes",
        "outcomes",
    ),
    "ingest_ledger": _with(
        "SELECT image_id, CASE WHEN ok THEN '/images/' ELSE 'failed: ' END || 'IMG_' || image_id || '.jpg' AS path_or_err, ok, batch FROM outcomes, (VALUES (1), (2)) b(batch) "
        "WHERE CASE batch WHEN 1 THEN image_id % 10 < 2 ELSE image_id % 10 >= 2 OR NOT ok END",
        "outcomes",
    ),
    "ingest_batch_counts": _with(
        "SELECT batch, count(*) FILTER (WHERE ok AND (batch = 1) = (image_id % 10 < 2)) AS n_loaded, "
        "count(*) FILTER (WHERE NOT ok AND (batch = 2 OR image_id % 10 < 2)) AS n_failed "
        "FROM outcomes, (VALUES (1, 1), (1, 2), (2, 1)) b(batch, run) GROUP BY batch, run",
        "outcomes",
    ),
    # sinks
    "write_pairs": _with("SELECT * FROM pairs", "pairs"),
    "write_results": _with(f"SELECT filename, {_NO_METRICS} AS metrics_json, tag, score FROM named", "named"),
    "run_metrics": _with(
        "SELECT 'run-1' AS run_id, CASE WHEN phase = 'baseline' THEN 'baseline_' ELSE '' END || split || '_' || metric "
        "AS name, CAST(NULL AS BIGINT) AS step, round(value, 6) AS value FROM metric_rows UNION ALL "
        "SELECT 'run-1', 'train_loss', epoch, round(loss, 6) FROM epoch_losses",
        "metric_rows",
        "epoch_losses",
    ),
    "run_params": "SELECT 'run-1' AS run_id, key, value FROM (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in _PARAMS.items())
    + ") p(key, value) UNION ALL SELECT 'run-1', s || '_samples', CAST((SELECT count(*) FROM embeddings WHERE "
    + _split("vec_id")
    + " = s) AS VARCHAR) FROM (VALUES ('train'), ('valid'), ('test')) x(s)",
    "row_counts": _with(
        "SELECT 'pairs' AS table_name, count(*) AS n_rows FROM pairs UNION ALL "
        "SELECT 'results', (SELECT count(*) FROM embeddings)",
        "pairs",
    ),
    # pairs
    "captions_by_image": _with(
        "SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY cap_no) - 1 AS position, caption, "
        "count(*) OVER (PARTITION BY image_id) AS n_captions FROM captions",
        "captions",
    ),
    "caption_totals": _with(
        "SELECT count(*) AS n_captions, count(DISTINCT image_id) AS n_images FROM captions", "captions"
    ),
    "eligible_images": _with("SELECT * FROM eligible", "eligible"),
    "sample_images": _with(
        f"SELECT * FROM eligible ORDER BY {_u('image_id')}, image_id LIMIT {catalog.SAMPLE_SIZE}", "eligible"
    ),
    "image_paths": _with(
        "SELECT image_id, '/images/' || file_name AS image_path FROM eligible JOIN images ON id = image_id",
        "eligible",
        "images",
    ),
    "captions_of_loaded": _with(
        "SELECT * FROM captions WHERE image_id IN (SELECT image_id FROM outcomes WHERE ok)", "outcomes"
    ),
    "sample_negatives": _with("SELECT * FROM negatives", "negatives"),
    "assign_split": f"SELECT doc_id, round({_u('doc_id')}, 9) AS u, {_split('doc_id')} AS split FROM documents",
    "split_counts": _with("SELECT split, count(*) AS total FROM pairs GROUP BY split", "pairs"),
    "split_counts_wide": _with(
        "SELECT "
        + ", ".join(f"count(*) FILTER (WHERE split = '{s}') AS n_{s}" for s in ("train", "valid", "test"))
        + ", count(*) AS n_records FROM pairs",
        "pairs",
    ),
    "pair_preview": _with(
        "SELECT image_id, split, left(text_positive, 40) AS text_positive_preview, "
        "left(text_negative, 40) AS text_negative_preview FROM pairs ORDER BY image_id LIMIT 10",
        "pairs",
    ),
    "distinct_categories": _with("SELECT DISTINCT category FROM pairs WHERE split = 'train'", "pairs"),
    # vectors
    "l2_normalize": _with(
        "SELECT image_id, round(sqrt(list_dot_product(u, u)), 6) AS norm, round(list_sum(u), 6) AS total, "
        "round(list_dot_product(u, e), 6) AS projection FROM (SELECT image_id, e, "
        "list_transform(s, lambda x: x / sqrt(list_dot_product(s, s))) AS u FROM "
        "(SELECT image_id, e, list_transform(e, lambda x: x * (label + 2)) AS s FROM vec))",
        "vec",
    ),
    "dot_product": _with("SELECT image_id, round(list_dot_product(img, pos), 6) AS dot FROM triplets", "triplets"),
    "cosine_similarity": _with(
        "SELECT image_id, round(list_cosine_similarity(pos, neg), 6) AS cosine FROM triplets", "triplets"
    ),
    "pair_scores": _with(
        "SELECT image_id, round(p, 6) AS pos_score, round(n, 6) AS neg_score, p > n AS correct FROM (SELECT image_id, "
        + _sigmoid(f"{SCALE} * list_dot_product(img, pos) - {BIAS}")
        + " AS p, "
        + _sigmoid(f"{SCALE} * list_dot_product(img, neg) - {BIAS}")
        + " AS n FROM triplets)",
        "triplets",
    ),
    "base64_roundtrip": "SELECT doc_id, md5(b) AS base64_md5, length(b) AS n_base64, from_base64(b) = encode(text) AS same "
    "FROM (SELECT doc_id, text, base64(encode(text)) AS b FROM documents)",
    "encode_texts": "WITH words AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS word FROM documents), "
    "counts AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket, "
    "count(*) AS n FROM words WHERE word <> '' GROUP BY ALL) SELECT doc_id, bucket, "
    "round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 6) AS weight FROM counts",
    # tagging
    "pluggable_encoder": _with(
        "SELECT doc_id, 64 AS dims, CAST(1 AS DOUBLE) AS norm, round(CAST(sum(n) / sqrt(sum(n * n)) AS DOUBLE), 6) AS total "
        "FROM byte_counts GROUP BY doc_id",
        "byte_counts",
    ),
    "predict_requests": _with(
        "SELECT filename, CAST(rank AS INTEGER) AS rank, tag, score FROM (SELECT doc_id AS filename, tag, score, lim, "
        "row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank, "
        "max(score) OVER (PARTITION BY doc_id) AS best FROM doc_scores JOIN (SELECT doc_id AS id, "
        f"CASE lang WHEN 'en' THEN 0.5 ELSE {fixed.TAG_SCORE_THRESHOLD} END AS lim FROM documents) ON id = doc_id) "
        f"WHERE CASE WHEN best >= lim THEN score >= lim ELSE rank <= {fixed.FALLBACK_TAGS} END",
        "doc_scores",
    ),
    "tag_prompts": "SELECT DISTINCT 'tag_' || label AS tag, 'This is a photo of tag_' || label || '.' AS prompt FROM embeddings",
    "tag_images": _with("SELECT image_id, CAST(rank AS INTEGER) AS rank, tag, score FROM selected", "selected"),
    "rank_tags": _with("SELECT image_id, CAST(rank AS INTEGER) AS rank, tag, score FROM ranked", "ranked"),
    "select_tags": _with(
        "SELECT image_id, CAST(count(*) AS INTEGER) AS num_tags, max(score) < 0.3 AS used_fallback FROM selected "
        "GROUP BY image_id",
        "selected",
    ),
    "tag_overrides": _override_sql(),
    "tag_custom_candidates": _custom_sql(),
    "tag_many_candidates": _many_sql(),
    "tag_image_files": _with(
        "SELECT 'doc_' || doc_id || '.' || ['jpg', 'PNG', 'txt', 'JpEg', 'mp4'][doc_id % 5 + 1] AS filename, doc_id % 11 <> 0 AS load_ok, "
        "CAST(rank - 1 AS INTEGER) AS pos, tag, score FROM documents LEFT JOIN (SELECT * FROM (SELECT doc_id, tag, score, "
        "row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank, max(score) OVER (PARTITION BY doc_id) AS best "
        f"FROM doc_scores WHERE doc_id % 11 <> 0) WHERE CASE WHEN best >= {fixed.TAG_SCORE_THRESHOLD} "
        f"THEN score >= {fixed.TAG_SCORE_THRESHOLD} ELSE rank <= {fixed.FALLBACK_TAGS} END) USING (doc_id) WHERE doc_id % 5 IN (0, 1, 3)",
        "doc_scores",
    ),
    "batch_infer": _with(
        f"SELECT {_FILE} AS filename, num_tags, num_scores, dims, norm, {_NO_METRICS} AS metrics_json FROM "
        "(SELECT image_id, CAST(len(e) AS INTEGER) AS dims, round(sqrt(list_dot_product(e, e)), 6) AS norm FROM vec) "
        "JOIN (SELECT image_id, CAST(count(*) AS INTEGER) AS num_tags FROM selected GROUP BY image_id) USING (image_id) "
        "JOIN (SELECT image_id, CAST(count(*) AS INTEGER) AS num_scores FROM ranked GROUP BY image_id) USING (image_id)",
        "selected",
    ),
    "encode_response": _with(
        f"SELECT {_FILE} AS filename, 'tags' AS kind, CAST(rank - 1 AS INTEGER) AS pos, tag, score FROM selected UNION ALL "
        f"SELECT {_FILE}, 'all_scores', CAST(rank - 1 AS INTEGER), tag, score FROM ranked",
        "selected",
    ),
    "flatten_results": _with("SELECT filename, CAST(rank AS INTEGER) AS rank, tag, score FROM named", "named"),
    "response_preview": _with(
        f"SELECT v.filename, {_NO_METRICS} AS metrics_json, num_tags, 80 AS preview_chars, "
        f"round(v.e[1], 6) AS first_value FROM (SELECT {_FILE} AS filename, e FROM vec) v JOIN (SELECT filename, "
        "CAST(count(*) AS INTEGER) AS num_tags FROM named GROUP BY filename) USING (filename) ORDER BY filename LIMIT 10",
        "named",
    ),
    "top_scores_per_image": _with(
        f"SELECT {_FILE} AS filename, CAST(rank AS INTEGER) AS rank, tag, score FROM ranked WHERE rank <= 10", "ranked"
    ),
    "tag_score_counts": _with(
        "SELECT tag, score, count(*) AS count FROM named GROUP BY tag, score ORDER BY count DESC, tag, score DESC LIMIT 20",
        "named",
    ),
    "tag_counts": _with(
        "SELECT tag, count(*) AS count FROM named GROUP BY tag", "named"
    ),
    "tags_per_image": _with(
        "SELECT num_tags, count(*) AS image_count FROM (SELECT CAST(count(*) AS INTEGER) AS num_tags FROM named "
        "GROUP BY filename) GROUP BY num_tags",
        "named",
    ),
    "parse_embeddings": _with(f"SELECT {_SUMMARY} FROM vec", "vec"),
    "embedding_dims": _with(
        "SELECT CAST(len(e) AS INTEGER) AS dims, count(*) AS image_count FROM vec GROUP BY dims", "vec"
    ),
    "parse_metrics": "SELECT event_id, CAST(round(CAST(value AS DECIMAL(18, 4)), 1) AS DOUBLE) AS inference_time_ms, "
    "CAST(NULL AS DOUBLE) AS gpu_memory_allocated_mb, CAST(NULL AS DOUBLE) AS gpu_memory_peak_mb, "
    "CAST(props ->> '$.k' AS DOUBLE) AS gpu_utilization_pct FROM events",
    "first_n_images": "SELECT 'IMG_' || vec_id || '.jpg' AS filename FROM embeddings ORDER BY filename "
    f"LIMIT {catalog.FIRST_IMAGES}",
    "similar_images": _with(
        "SELECT image_id, round(s, 6) AS similarity, CAST(row_number() OVER (ORDER BY s DESC, image_id) AS INTEGER) AS rank "
        "FROM (SELECT v.image_id, list_cosine_similarity(v.e, q.e) AS s FROM vec v, vec q WHERE q.image_id = 0 "
        "AND v.image_id <> 0) ORDER BY s DESC, image_id LIMIT 10",
        "vec",
    ),
    "similar_results": _with(
        f"SELECT filename, round(s, 6) AS similarity, CAST(row_number() OVER (ORDER BY s DESC, filename) AS INTEGER) AS rank "
        f"FROM (SELECT 'IMG_' || v.image_id || '.jpg' AS filename, list_cosine_similarity(v.e, q.e) AS s FROM vec v, vec q "
        "WHERE q.image_id = 3 AND v.image_id <> 3) ORDER BY s DESC, filename LIMIT 10",
        "vec",
    ),
    # evaluation and runs
    "recall_at_1_copies": _with(
        "SELECT 'all' AS split, round(avg(CAST(id = image_id AS DOUBLE)), 6) AS recall_at_1, count(*) AS n_images FROM "
        "(SELECT a.image_id, f.id, row_number() OVER (PARTITION BY a.image_id ORDER BY round(list_dot_product(a.e, t.v), 12) DESC, f.id) AS k "
        "FROM vec a, tags t JOIN (SELECT label, min(image_id) AS id FROM vec GROUP BY label) f ON t.pos = f.label) WHERE k = 1",
        "tags",
    ),
    "recall_at_1": _with(
        "SELECT 'all' AS split, round(avg(CAST(best = image_id AS DOUBLE)), 6) AS recall_at_1, count(*) AS n_images FROM "
        "(SELECT a.image_id, arg_max(b.image_id, list_dot_product(a.img, b.pos)) AS best FROM triplets a, triplets b "
        "GROUP BY a.image_id)",
        "triplets",
    ),
    "triplet_accuracy": _with(
        "SELECT split, round(triplet_accuracy, 6) AS triplet_accuracy FROM evaluated WHERE phase = 'baseline'", "evaluated"
    ),
    "evaluate_splits": _with(
        "SELECT split, round(recall_at_1, 6) AS recall_at_1, round(triplet_accuracy, 6) AS triplet_accuracy FROM evaluated "
        "WHERE phase = 'baseline'",
        "evaluated",
    ),
    "metric_delta": _with(
        "SELECT split, metric, round(b.value, 6) AS baseline, round(f.value, 6) AS final, "
        "round(f.value - b.value, 6) AS delta FROM (SELECT * FROM metric_rows WHERE phase = 'baseline') b JOIN "
        "(SELECT * FROM metric_rows WHERE phase = 'final') f USING (split, metric)",
        "metric_rows",
    ),
    "best_epoch": _with(
        "SELECT run_id, CASE WHEN max(recall) > 0 THEN min(epoch) FILTER (WHERE recall = top) END AS best_epoch, "
        "round(max(recall), 6) AS best_recall FROM (SELECT *, max(recall) OVER (PARTITION BY run_id) AS top FROM log) "
        "GROUP BY run_id",
        "log",
    ),
    "running_best": _with(
        "SELECT run_id, epoch, round(recall, 6) AS recall, round(max(recall) OVER (PARTITION BY run_id ORDER BY epoch), 6) "
        "AS best_so_far FROM log",
        "log",
    ),
    "trainable_share": "SELECT CAST(sum(numel) AS BIGINT) AS total_params, CAST(sum(t) AS BIGINT) AS trainable_params, "
    "round(100.0 * CAST(sum(t) AS DOUBLE) / CAST(sum(numel) AS DOUBLE), 2) AS trainable_pct FROM (SELECT n_chars AS numel, "
    "CASE WHEN "
    + " OR ".join(f"contains(lang || '_model.' || source || '.' || doc_id, '{p}')" for p in catalog.TRAINABLE_PARTS)
    + " THEN n_chars ELSE 0 END AS t FROM documents)",
    "latest_version": _with(
        "SELECT model, max(CAST(version AS BIGINT)) AS latest_version FROM versions GROUP BY model", "versions"
    ),
    "recent_versions": _with(
        "SELECT version, status, left(run_id, 12) AS run_id_prefix FROM versions ORDER BY CAST(version AS BIGINT) DESC LIMIT 5",
        "versions",
    ),
    # training
    "assign_batches": f"SELECT split, image_id, rn // {fixed.BATCH_SIZE} AS batch_id, "
    f"CAST(rn % {fixed.BATCH_SIZE} AS INTEGER) AS batch_pos FROM (SELECT split, image_id, row_number() OVER "
    f"(PARTITION BY split ORDER BY {_u('split', 'image_id')}, image_id) - 1 AS rn FROM (SELECT vec_id AS image_id, "
    f"{_split('vec_id')} AS split FROM embeddings))",
    "contrastive_loss": _with(
        "SELECT split, batch_id, CAST(sqrt(count(*)) AS INTEGER) AS n, "
        "round(avg(-(least(z, 0.0) - ln(1.0 + exp(-abs(z))))), 6) AS loss FROM (SELECT a.split, a.batch_id, "
        f"CASE WHEN a.image_id = b.image_id THEN 1.0 ELSE -1.0 END * ({SCALE} * list_cosine_similarity(a.img, b.pos) - {BIAS}) AS z "
        "FROM batched a JOIN batched b ON a.split = b.split AND a.batch_id = b.batch_id) GROUP BY split, batch_id",
        "batched",
    ),
    "epoch_loss": _with(
        "SELECT CAST(epoch AS INTEGER) AS epoch, round(loss, 6) AS loss, n_batches FROM epoch_losses", "epoch_losses"
    ),
    "fit_heads": _with(
        "SELECT CAST(epoch AS INTEGER) AS epoch, round(l.loss, 6) AS loss, round(avg(CAST(best_id = image_id AS DOUBLE)), 6) AS valid_recall_at_1, "
        "round(avg(CAST(win AS DOUBLE)), 6) AS valid_triplet_accuracy FROM (SELECT a.epoch, a.image_id, any_value(a.win) AS win, "
        "arg_max(b.image_id, list_dot_product(a.img, b.pos)) AS best_id FROM seen a JOIN seen b USING (epoch) GROUP BY a.epoch, a.image_id) "
        "JOIN epoch_losses l USING (epoch) GROUP BY epoch, l.loss",
        "seen",
        "epoch_losses",
    ),
    "fit_steps": _with(
        "SELECT CAST(s.epoch AS INTEGER) AS epoch, batch_id AS step, CAST(1 AS BIGINT) AS n_batches, round(loss, 6) AS loss FROM fit JOIN step_rows s USING (t)",
        "fit",
    ),
    "fitted_heads": _with(
        "SELECT head, CAST(r - 1 AS INTEGER) AS row, CAST(c - 1 AS INTEGER) AS col, round(w[r][c], 6) AS value FROM "
        "(SELECT 'image' AS head, wi AS w FROM heads UNION ALL SELECT 'text', wt FROM heads), range(1, 65) a(r), range(1, 65) b(c)",
        "heads",
    ),
    "head_gradient": _gradient_sql(),
    "register_head": "SELECT CAST((SELECT max(o_orderkey) + 1 FROM orders) AS VARCHAR) AS version, 'READY' AS status, 'run-1' AS run_id, "
    "head, CAST(row AS INTEGER) AS row, 64 AS dims FROM (VALUES ('image'), ('text')) h(head), range(0, 64) r(row)",
}
SQL["batch_infer_sql"] = SQL["predict_requests"]
SQL["logged_metrics"] = f"SELECT r.run_id, m.* EXCLUDE (run_id) FROM ({SQL['run_metrics']}) m, (VALUES ('run-1'), ('run-2'), ('run-3')) r(run_id)"
SQL["logged_params"] = f"SELECT r.run_id, m.* EXCLUDE (run_id) FROM ({SQL['run_params']}) m, (VALUES ('run-1'), ('run-2')) r(run_id)"
