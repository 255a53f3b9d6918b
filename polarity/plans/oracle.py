"""Equivalent SQL for each registered query, runnable by DuckDB on the same
tables (views named after the parquet files). Used as the correctness
oracle: same column names, same rounding, same seeded order keys."""

from __future__ import annotations

from polarity.config import MEMBER_WEIGHTS
from polarity.operators.epochs import PRIME, round_keys

SEQ_LEN, MAX_LEN = 500, 512


def tok(x: str) -> str:
    """The tokenizer of ``functions.text.tokenize`` in DuckDB SQL."""
    return (r"coalesce(list_filter(string_split_regex(regexp_replace(regexp_replace(lower(" + x +
            r"), '([^'' ])(''ll|''re|''ve|n''t|''s|''m|''d)', '\1 \2', 'g'), "
            r"'([^\p{L}\p{N} \t\r\n\f''])', ' \1 ', 'g'), '[ \t\r\n\f]+'), lambda t: t <> ''), "
            r"CAST([] AS VARCHAR[]))")


STRIP = "regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def md5key(seed: str, *cols: str) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"md5(concat_ws(':', '{seed}', {parts}))"


TOKS = f"toks AS (SELECT doc_id, {tok('text')} AS tokens FROM documents)"


def vocab_cte(first_id: int = 0, name: str = "vocab", toks: str = "toks") -> str:
    return f"""wc_{name} AS (SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM {toks})
      GROUP BY word),
    {name} AS (SELECT CAST(rn - 1 + {first_id} AS INTEGER) AS id, word, CAST(n AS BIGINT) AS n
      FROM (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rn FROM wc_{name}))"""


def lookup_cte(name: str, toks: str, vocab: str, n: int, unk: int) -> str:
    """(doc_id, ids) - unpadded id list of the first n tokens."""
    return f"""ex_{name} AS (SELECT doc_id, unnest(tokens[1:{n}]) AS word,
        unnest(generate_series(1, len(tokens[1:{n}]))) AS pos FROM {toks}),
    lk_{name} AS (SELECT e.doc_id, list(coalesce(v.id, {unk}) ORDER BY e.pos) AS ids
        FROM ex_{name} e LEFT JOIN {vocab} v ON e.word = v.word GROUP BY e.doc_id),
    {name} AS (SELECT t.doc_id, coalesce(l.ids, CAST([] AS INTEGER[])) AS ids
        FROM {toks} t LEFT JOIN lk_{name} l USING (doc_id))"""


LOOKUP = f"""WITH {TOKS}, {vocab_cte()}, {lookup_cte('lk', 'toks', 'vocab', SEQ_LEN, -1)}"""

EXAMPLES = f"""WITH toks2 AS (SELECT doc_id, {tok(STRIP.format(x='text'))} AS tokens FROM documents),
    {TOKS}, {vocab_cte(4, 'vocab4')}, {lookup_cte('lk4', 'toks2', 'vocab4', MAX_LEN - 2, 3)},
    ex AS (SELECT doc_id, CAST(list_resize(list_concat([1], ids, [2]), {MAX_LEN}, 0) AS INTEGER[])
        AS input_ids FROM lk4)"""

MASK = "CAST(list_transform(input_ids, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS INTEGER[])"

EMB = """emb AS (SELECT vec_id, embedding, label,
      CASE WHEN label <= 3 THEN 'labeled' WHEN label <= 7 THEN 'real' ELSE 'fake' END AS role,
      CAST(embedding[1:2] AS DOUBLE[]) AS logits, CAST(label % 2 AS INTEGER) AS target
    FROM embeddings)"""

VOCAB_VEC = f"""WITH {TOKS}, {vocab_cte()}, {EMB},
    vv AS (SELECT v.id, v.word, CAST(e.embedding AS DOUBLE[]) AS vec
      FROM vocab v JOIN emb e ON e.vec_id = v.id WHERE e.role IN ('labeled', 'real'))"""

COS = ("list_dot_product({a}, {b}) / greatest(sqrt(list_dot_product({a}, {a})) * "
       "sqrt(list_dot_product({b}, {b})), 1e-8)")


def rank_cte(name: str, src: str, seed: str, cols=("doc_id",)) -> str:
    order = ", ".join(cols)
    return (f"{name} AS (SELECT *, row_number() OVER (ORDER BY {md5key(seed, *cols)}, {order}) - 1"
            f" AS p, count(*) OVER () AS n FROM {src})")


UNLABELED = "(SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"

TILED = f"""lab AS (SELECT d.doc_id, l.quality AS label FROM documents d JOIN labels l USING (doc_id)),
    times AS (SELECT CAST(ceil((SELECT count(*) FROM {UNLABELED}) / (SELECT count(*) FROM lab))
      AS BIGINT) AS t),
    tiled AS (SELECT doc_id, CAST(unnest(generate_series(0, t - 1)) AS INTEGER) AS copy, label
      FROM lab, times)"""


def _weights_values() -> str:
    return ", ".join(f"('{m}', CAST({w} AS DECIMAL(28,18)))" for m, w in MEMBER_WEIGHTS)


VOTES = f"""w(member, weight) AS (VALUES {_weights_values()}),
    vh AS (SELECT d.doc_id, m.weight, md5(concat_ws(':', m.member, CAST(d.doc_id AS VARCHAR))) AS h
      FROM documents d, w m),
    vv AS (SELECT doc_id, weight, CASE WHEN substr(h, 1, 1) < '8' THEN 'positive' ELSE 'negative' END
      AS s FROM vh WHERE substr(h, 2, 1) <> '0'),
    ids AS (SELECT DISTINCT doc_id FROM {UNLABELED}),
    agg AS (SELECT doc_id,
      sum(CASE WHEN s = 'positive' THEN weight ELSE CAST(0 AS DECIMAL(28,18)) END) AS pos,
      sum(CASE WHEN s = 'negative' THEN weight ELSE CAST(0 AS DECIMAL(28,18)) END) AS neg
      FROM vv GROUP BY doc_id),
    tally AS (SELECT ids.doc_id, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg
      FROM ids LEFT JOIN agg USING (doc_id))"""

STEPS = """st AS (SELECT CAST(user_id % 3 AS INTEGER) AS epoch, value AS loss,
      event_id % 2 + 1 AS bs, ts, event_id, user_id, event_type FROM events)"""

WINDOWS = f"""WITH {STEPS},
    rk AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY ts, event_id) - 1 AS r FROM st),
    win AS (SELECT epoch, r // 50 AS w, count(*) AS steps, CAST(sum(bs) AS BIGINT) AS samples,
      sum(loss * bs) / sum(CAST(bs AS DOUBLE)) AS loss FROM rk GROUP BY epoch, r // 50),
    off AS (SELECT epoch, coalesce(sum(nw) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS o FROM (SELECT epoch, count(*) AS nw FROM win GROUP BY epoch)),
    sw AS (SELECT win.epoch, CAST(w AS BIGINT) AS "window", CAST(o + w + 1 AS BIGINT) AS global_step,
      steps, samples, round(loss, 9) AS loss FROM win JOIN off USING (epoch))"""

LSE = "list_max({x}) + ln(list_sum(list_transform({x}, lambda v: exp(v - list_max({x})))))"

LOSSES = f"""WITH {EMB},
    l AS (SELECT role, target, logits, {LSE.format(x='logits')} AS lse FROM emb),
    k AS (SELECT role, lse, lse - logits[target + 1] AS ce,
      greatest(lse, 0) + ln(1 + exp(-abs(lse))) AS sp FROM l),
    agg AS (SELECT avg(ce) FILTER (WHERE role = 'labeled') AS sup,
      0.5 * (-avg(lse) FILTER (WHERE role = 'real') + avg(sp) FILTER (WHERE role = 'real')
             + avg(sp) FILTER (WHERE role = 'fake')) AS unsup FROM k)"""


def nb_fit_cte(name: str, train: str) -> str:
    """Naive Bayes weights ``wt_<name>`` and prior ``pri_<name>`` from a
    (tokens, p, lam) relation."""
    return f"""pw_{name} AS (SELECT word, sum(lam * p) AS a, sum(lam * (1 - p)) AS b
      FROM (SELECT unnest(tokens) AS word, p, lam FROM {train}) GROUP BY word),
    tot_{name} AS (SELECT sum(a) AS ta, sum(b) AS tb, count(*) AS nv FROM pw_{name}),
    wt_{name} AS (SELECT word, ln((a + 1) / (ta + nv)) - ln((b + 1) / (tb + nv)) AS weight
      FROM pw_{name}, tot_{name}),
    pri_{name} AS (SELECT ln(sum(lam * p) / sum(lam * (1 - p))) AS prior FROM {train})"""


def nb_score_cte(name: str, model: str, docs: str) -> str:
    """``sc_<name>`` (doc_id, score) for every row of ``docs`` (doc_id, tokens)."""
    return f"""occ_{name} AS (SELECT doc_id, unnest(tokens) AS word FROM {docs}),
    s_{name} AS (SELECT o.doc_id, sum(w.weight) AS s FROM occ_{name} o JOIN wt_{model} w USING (word)
      GROUP BY o.doc_id),
    sc_{name} AS (SELECT d.doc_id, pri_{model}.prior + coalesce(s_{name}.s, 0) AS score
      FROM {docs} d LEFT JOIN s_{name} USING (doc_id), pri_{model})"""


NB = f"""WITH {TOKS},
    lab AS (SELECT t.doc_id, t.tokens, CAST(l.quality AS DOUBLE) AS p, CAST(1.0 AS DOUBLE) AS lam
      FROM toks t JOIN labels l USING (doc_id)),
    {nb_fit_cte('m', 'lab')}"""

ACCURACY = """count(*) AS n, CAST(count_if(pred = label) AS BIGINT) AS correct,
        round(avg(CAST(pred = label AS DOUBLE)), 9) AS accuracy,
        CAST(count_if(pred = 1 AND label = 1) AS BIGINT) AS tp,
        CAST(count_if(pred = 1 AND label <> 1) AS BIGINT) AS fp,
        CAST(count_if(pred <> 1 AND label <> 1) AS BIGINT) AS tn,
        CAST(count_if(pred <> 1 AND label = 1) AS BIGINT) AS fn"""

SUPERVISED = f"""WITH
      stoks AS (SELECT doc_id, {tok(STRIP.format(x='text'))} AS tokens FROM documents),
      {rank_cte('r', '(SELECT doc_id FROM documents JOIN labels USING (doc_id))', '230')},
      train AS (SELECT s.tokens, CAST(l.quality AS DOUBLE) AS p, CAST(1.0 AS DOUBLE) AS lam
        FROM r JOIN stoks s USING (doc_id) JOIN labels l USING (doc_id)
        WHERE r.p >= ceil(r.n * CAST(0.1 AS DOUBLE))),
      {nb_fit_cte('m', 'train')}"""

def epochs_sql(epochs: int, size: int, seed) -> str:
    """The keyed permutation of positions, pass by pass; positions that need
    more passes than WALKS would come out at n or more and fail the compare."""
    walks = 12
    keys = ", ".join(
        f"({e}, " + ", ".join(f"{m}::BIGINT, {c}::BIGINT" for m, c in round_keys(seed, e)) + ")"
        for e in range(epochs))
    sq = lambda v, k: f"(({v} * m{k} + c{k}) % {PRIME})"
    moved = lambda v, k: f"({sq(v, k)} * {sq(v, k)} % {PRIME})"
    ctes, last = [], "w0"
    for i in range(walks):
        steps = (f"s{i}a AS (SELECT *, (x // b + {moved('(x % b)', 0)}) % a AS l, x % b AS r FROM {last}), "
                 f"s{i}b AS (SELECT * REPLACE ((r + {moved('l', 1)}) % b AS r) FROM s{i}a), "
                 f"s{i}c AS (SELECT * REPLACE ((l + {moved('r', 2)}) % a AS l) FROM s{i}b), "
                 f"s{i}d AS (SELECT * REPLACE ((r + {moved('l', 3)}) % b AS r) FROM s{i}c), ")
        keep = "l * b + r" if i == 0 else "CASE WHEN x < n THEN x ELSE l * b + r END"
        ctes.append(steps + f"w{i + 1} AS (SELECT * EXCLUDE (l, r) REPLACE ({keep} AS x) FROM s{i}d)")
        last = f"w{i + 1}"
    names = ", ".join(f"m{k}, c{k}" for k in range(4))
    return f"""WITH {rank_cte('r', '(SELECT doc_id FROM documents)', str(seed))},
      k(epoch, {names}) AS (VALUES {keys}),
      g AS (SELECT count(*) AS n, greatest(1, ceil(sqrt(count(*))))::BIGINT AS a FROM documents),
      w0 AS (SELECT r.doc_id, k.*, g.n, g.a, greatest(1, (g.n + g.a - 1) // g.a) AS b, r.p::BIGINT AS x
             FROM r, k, g), {", ".join(ctes)}
      SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, CAST(x // {size} AS BIGINT) AS batch_id,
        CAST(x % {size} AS INTEGER) AS slot FROM {last}"""


ORACLE = {
    "strip_tags": "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS text FROM pages",
    "encode_label": """SELECT d.doc_id,
        CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment,
        CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS label
      FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "tokenize": f"SELECT doc_id, {tok('text')} AS tokens FROM documents",
    "pad_truncate": f"WITH {TOKS} SELECT doc_id, list_resize(tokens, {SEQ_LEN}, '') AS tokens_500 "
                    "FROM toks",
    "build_vocabulary": f"WITH {TOKS}, {vocab_cte()} SELECT id, word, n FROM vocab",
    "lookup_ids": f"{LOOKUP} SELECT doc_id, CAST(list_resize(ids, {SEQ_LEN}, -1) AS INTEGER[]) "
                  "AS ids FROM lk",
    "encode_specials": f"{EXAMPLES} SELECT doc_id, input_ids FROM ex",
    "attention_mask": f"{EXAMPLES} SELECT doc_id, {MASK} AS attention_mask FROM ex",
    "build_examples": f"""{EXAMPLES} SELECT ex.doc_id, input_ids, {MASK} AS attention_mask,
        l.quality AS label FROM ex LEFT JOIN labels l USING (doc_id)""",
    "ngram_features": f"""WITH {TOKS},
      g AS (SELECT doc_id, w AS width, unnest(list_transform(generate_series(1, len(tokens) - w + 1),
        lambda i: array_to_string(tokens[i:i + w - 1], ' '))) AS gram
        FROM toks, (VALUES (3), (4), (5), (6), (7)) ws(w) WHERE len(tokens) >= w)
      SELECT doc_id, width, gram, count(*) AS n FROM g GROUP BY doc_id, width, gram""",
    "vocab_vectors": f"""WITH {TOKS}, {vocab_cte()}
      SELECT v.id, v.word, e.embedding AS vector FROM vocab v JOIN embeddings e ON e.vec_id = v.id""",
    "embed_tokens": f"""{LOOKUP},
      padded AS (SELECT doc_id, list_resize(ids, {SEQ_LEN}, -1) AS ids FROM lk),
      ex AS (SELECT doc_id, unnest(ids) AS tid, unnest(generate_series(0, len(ids) - 1)) AS pos
        FROM padded)
      SELECT ex.doc_id, CAST(ex.pos AS INTEGER) AS pos,
        coalesce(e.embedding, list_resize(CAST([] AS FLOAT[]), 64, CAST(0 AS FLOAT))) AS vector
      FROM ex LEFT JOIN embeddings e ON e.vec_id = ex.tid""",
    "log_sum_exp": f"""SELECT vec_id, round({LSE.format(x='e')}, 9) AS lse
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""",
    "argmax_class": """SELECT vec_id,
        CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS cls,
        CAST(list_position(embedding[1:2], list_max(embedding[1:2])) - 1 AS INTEGER) AS cls2
      FROM embeddings""",
    "k_max": """WITH ex AS (SELECT vec_id, unnest(embedding) AS v,
        unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
      r AS (SELECT vec_id, v, i, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS rk
        FROM ex)
      SELECT vec_id, list(v ORDER BY i) AS top FROM r WHERE rk <= 8 GROUP BY vec_id""",
    "linear_score": f"""WITH {EMB},
      ex AS (SELECT target AS out, unnest(CAST(embedding AS DOUBLE[])) AS x,
        unnest(generate_series(0, len(embedding) - 1)) AS pos FROM emb),
      m AS (SELECT out, pos, avg(x) AS mean FROM ex GROUP BY out, pos),
      w AS (SELECT out, list(mean ORDER BY pos) AS w FROM m GROUP BY out),
      wn AS (SELECT out, list_transform(w, lambda t: t / sqrt(list_sum(list_transform(w,
        lambda u: u * u)))) AS wn FROM w)
      SELECT e.vec_id, CAST(wn.out AS INTEGER) AS out,
        round(list_dot_product(CAST(e.embedding AS DOUBLE[]), wn.wn) + 0.0, 6) AS score
      FROM embeddings e, wn""",
    "nearest_word": f"""{VOCAB_VEC},
      q AS (SELECT vec_id AS qid, CAST(embedding AS DOUBLE[]) AS qv FROM emb WHERE role = 'fake'),
      s AS (SELECT q.qid, vv.id AS word_id, vv.word, {COS.format(a='q.qv', b='vv.vec')} AS sim
        FROM q, vv)
      SELECT qid, word_id, word, round(sim, 6) AS sim FROM s
      QUALIFY row_number() OVER (PARTITION BY qid ORDER BY sim DESC, word_id) = 1""",
    "decode_sentence": f"""{VOCAB_VEC},
      lq AS (SELECT vec_id // 5 AS sent_id, vec_id % 5 AS pos, CAST(embedding AS DOUBLE[]) AS qv
        FROM emb WHERE role = 'fake'),
      s AS (SELECT lq.sent_id, lq.pos, vv.word FROM lq, vv
        QUALIFY row_number() OVER (PARTITION BY lq.sent_id, lq.pos
          ORDER BY {COS.format(a='lq.qv', b='vv.vec')} DESC, vv.id) = 1)
      SELECT sent_id, string_agg(word, ' ' ORDER BY pos) AS sentence FROM s GROUP BY sent_id""",
    "global_rank": f"""SELECT doc_id, CAST(row_number() OVER (ORDER BY {md5key('7', 'doc_id')},
        doc_id) - 1 AS BIGINT) AS pos FROM documents""",
    "sample_exact": f"""WITH {rank_cte('r', 'documents', '7')}
      SELECT doc_id FROM r WHERE p < round_even(n * CAST(0.5 AS DOUBLE), 0)""",
    "complement": f"""WITH {rank_cte('r', 'documents', '7')}
      SELECT doc_id FROM r
      WHERE p >= round_even(n * (CAST(1 AS DOUBLE) - CAST(0.3 AS DOUBLE)), 0)""",
    "split_three": f"""WITH {rank_cte('r', '(SELECT doc_id FROM documents)', '7')},
      t AS (SELECT doc_id, p < round_even(n * (CAST(1 AS DOUBLE) - CAST(0.3 AS DOUBLE)), 0)
        AS in_train FROM r),
      {rank_cte('r2', '(SELECT doc_id FROM t WHERE in_train)', '7/labeled')}
      SELECT t.doc_id, CASE WHEN r2.p < round_even(r2.n * CAST(0.2 AS DOUBLE), 0) THEN 'labeled'
        WHEN t.in_train THEN 'unlabeled' ELSE 'test' END AS part
      FROM t LEFT JOIN r2 USING (doc_id)""",
    "split_train_valid": f"""WITH
      {rank_cte('r', '(SELECT doc_id FROM documents JOIN labels USING (doc_id))', '230')}
      SELECT doc_id, CASE WHEN p < ceil(n * CAST(0.1 AS DOUBLE)) THEN 'valid' ELSE 'train' END
        AS part FROM r""",
    "assign_batches": f"""WITH {rank_cte('r', '(SELECT doc_id FROM documents)', '7:0')}
      SELECT doc_id, 0 AS epoch, CAST(p // 64 AS BIGINT) AS batch_id,
        CAST(p % 64 AS INTEGER) AS slot FROM r""",
    "epoch_batches": epochs_sql(10, 64, 7),
    "running_samples": f"""WITH {STEPS}
      SELECT event_id, epoch,
        CAST(sum(bs) OVER (PARTITION BY epoch ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
          AS epoch_samples,
        CAST(sum(bs) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS samples
      FROM st""",
    "exponential_histogram": f"""WITH {EMB},
      ex AS (SELECT role, unnest(CAST(embedding AS DOUBLE[])) AS x FROM emb),
      p AS (SELECT role, CAST(sign(x) AS INTEGER) AS sign, abs(x) AS s,
        CASE WHEN x <> 0 THEN CAST(floor(log2(abs(x))) AS INTEGER) END AS g FROM ex WHERE x IS NOT NULL),
      q AS (SELECT role, sign, s, CASE WHEN s < pow(2.0::DOUBLE, g) THEN g - 1
        WHEN s >= pow(2.0::DOUBLE, g + 1) THEN g + 1 ELSE g END AS exponent FROM p),
      b AS (SELECT role, sign, exponent,
        CAST(floor((s / pow(2.0::DOUBLE, exponent) - 1) * 8) AS INTEGER) AS sub_bucket FROM q)
      SELECT role, sign, exponent, sub_bucket,
        CASE WHEN sign = 0 THEN 0.0 ELSE least((1 + sub_bucket / 8.0::DOUBLE) * sign,
          (1 + (sub_bucket + 1) / 8.0::DOUBLE) * sign) * pow(2.0::DOUBLE, exponent) END::DOUBLE AS lo,
        CASE WHEN sign = 0 THEN 0.0 ELSE greatest((1 + sub_bucket / 8.0::DOUBLE) * sign,
          (1 + (sub_bucket + 1) / 8.0::DOUBLE) * sign) * pow(2.0::DOUBLE, exponent) END::DOUBLE AS hi,
        count(*) AS n FROM b GROUP BY ALL""",
    "tile_labeled": f"WITH {TILED} SELECT doc_id, copy, label FROM tiled",
    "zip_batches": f"""WITH {TILED},
      {rank_cte('lr', 'tiled', '1:0', ('doc_id', 'copy'))},
      {rank_cte('u1', UNLABELED, '2:0')},
      {rank_cte('u2', UNLABELED, '3:0')}
      SELECT 0 AS epoch, CAST(lr.p // 64 AS BIGINT) AS batch_id, CAST(lr.p % 64 AS INTEGER) AS slot,
        lr.doc_id AS label_id, lr.copy AS label_copy, lr.label AS label,
        u1.doc_id AS unlabel1_id, u2.doc_id AS unlabel2_id
      FROM lr JOIN u1 ON lr.p = u1.p JOIN u2 ON u1.p = u2.p
      WHERE lr.p // 64 < lr.n // 64 AND u1.p // 64 < u1.n // 64 AND u2.p // 64 < u2.n // 64""",
    "weighted_vote": f"""WITH {VOTES}
      SELECT doc_id, CAST(pos AS DOUBLE) AS positive, CAST(neg AS DOUBLE) AS negative FROM tally""",
    "ensemble_submission": f"""WITH {VOTES}
      SELECT doc_id, CASE WHEN pos >= neg THEN 'positive' ELSE 'negative' END AS sentiment
      FROM tally""",
    "weighted_loss": f"""WITH {STEPS}
      SELECT epoch, round(sum(loss * bs) / sum(CAST(bs AS DOUBLE)), 9) AS loss FROM st
      GROUP BY epoch""",
    "step_window": f"""{WINDOWS}
      SELECT epoch, "window", global_step, steps, samples, loss FROM sw""",
    "metrics_long": f"""{WINDOWS}
      SELECT 'events' AS run, 'batch-loss' AS tag, global_step AS step, loss AS value FROM sw
      UNION ALL
      SELECT 'events', 'batch-samples', global_step, CAST(samples AS DOUBLE) FROM sw""",
    "epoch_summary": f"""WITH {STEPS}
      SELECT epoch, count(*) AS steps, round(avg(loss), 9) AS loss_mean,
        round(avg(CAST(bs AS DOUBLE)), 9) AS batch_size_mean FROM st GROUP BY epoch""",
    "sup_loss": f"{LOSSES} SELECT round(sup, 9) AS sup_loss FROM agg",
    "unsup_loss": f"{LOSSES} SELECT round(unsup, 9) AS unsup_loss FROM agg",
    "total_loss": f"{LOSSES} SELECT round(sup + 1.0 * unsup, 9) AS total_loss FROM agg",
    "mean_vector": f"""WITH {EMB},
      ex AS (SELECT role, unnest(CAST(embedding AS DOUBLE[])) AS x,
        unnest(generate_series(0, len(embedding) - 1)) AS pos FROM emb)
      SELECT role, CAST(pos AS INTEGER) AS pos, round(avg(x), 9) AS mean FROM ex
      GROUP BY role, pos""",
    "feature_gap": f"""WITH {EMB},
      ex AS (SELECT role = 'real' AS a, unnest(CAST(embedding AS DOUBLE[])) AS x,
        unnest(generate_series(0, len(embedding) - 1)) AS pos FROM emb WHERE role <> 'labeled'),
      pd AS (SELECT pos, avg(x) FILTER (WHERE a) AS ma, avg(x) FILTER (WHERE NOT a) AS mb
        FROM ex GROUP BY pos)
      SELECT round(avg(pow(ma - mb, 2)), 9) AS feature_gap FROM pd""",
    "feature_histogram": f"""WITH {EMB},
      ex AS (SELECT role, unnest(CAST(embedding AS DOUBLE[])) AS x FROM emb)
      SELECT role, CAST(CASE WHEN x < CAST(-0.5 AS DOUBLE) THEN 0
          WHEN x >= CAST(0.5 AS DOUBLE) THEN 21
          ELSE least(floor((x - CAST(-0.5 AS DOUBLE)) * CAST(20 AS DOUBLE) / CAST(1.0 AS DOUBLE))
            + 1, 20) END AS INTEGER) AS bucket,
        count(*) AS n FROM ex GROUP BY ALL""",
    "latest_prediction": """SELECT user_id, arg_max(event_type, ts) AS event_type FROM events
      GROUP BY user_id""",
    "nb_weights": f"{NB} SELECT word, round(weight, 9) AS weight FROM wt_m",
    "nb_score": f"""{NB}, {nb_score_cte('all', 'm', 'toks')}
      SELECT doc_id, round(score, 6) AS score, CAST(score > 0 AS INTEGER) AS pred FROM sc_all""",
    "accuracy": f"""{NB}, {nb_score_cte('lab', 'm', 'lab')},
      j AS (SELECT score, CAST(score > 0 AS INTEGER) AS pred, l.quality AS label
        FROM sc_lab JOIN labels l USING (doc_id))
      SELECT {ACCURACY} FROM j""",
    "semi_nb_score": f"""{NB},
      unl AS (SELECT doc_id, tokens FROM toks WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
      {nb_score_cte('u', 'm', 'unl')},
      soft AS (SELECT doc_id, round(1.0 / (1.0 + exp(-greatest(least(score, 30.0), -30.0))), 6) AS p
        FROM sc_u),
      train2 AS (SELECT tokens, p, lam FROM lab
        UNION ALL SELECT u.tokens, s.p, CAST(0.5 AS DOUBLE) FROM unl u JOIN soft s USING (doc_id)),
      {nb_fit_cte('m2', 'train2')}, {nb_score_cte('all', 'm2', 'toks')}
      SELECT doc_id, round(score, 6) AS score, CAST(score > 0 AS INTEGER) AS pred FROM sc_all""",
    "submission": f"""{NB},
      unl AS (SELECT doc_id, tokens FROM toks WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
      {nb_score_cte('u', 'm', 'unl')}
      SELECT doc_id, CASE WHEN score > 0 THEN 'positive' ELSE 'negative' END AS sentiment
      FROM sc_u""",
    "pipeline_submission": f"""{SUPERVISED},
      unl AS (SELECT doc_id, tokens FROM stoks WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
      {nb_score_cte('u', 'm', 'unl')}
      SELECT doc_id, CASE WHEN score > 0 THEN 'positive' ELSE 'negative' END AS sentiment
      FROM sc_u""",
    "pipeline_valid_metrics": f"""{SUPERVISED},
      val AS (SELECT s.doc_id, s.tokens FROM r JOIN stoks s USING (doc_id)
        WHERE r.p < ceil(r.n * CAST(0.1 AS DOUBLE))),
      {nb_score_cte('v', 'm', 'val')},
      j AS (SELECT score, CAST(score > 0 AS INTEGER) AS pred, l.quality AS label,
          CASE WHEN l.quality = 1 THEN -score ELSE score END AS z
        FROM sc_v JOIN labels l USING (doc_id))
      SELECT {ACCURACY}, round(avg(greatest(z, 0) + ln(1 + exp(-abs(z)))), 6) AS loss FROM j""",
    "pipeline_semi_metrics": f"""WITH {TOKS},
      base AS (SELECT t.doc_id, t.tokens, l.quality AS label FROM toks t JOIN labels l
        USING (doc_id)),
      {rank_cte('r', '(SELECT doc_id FROM base)', '7')},
      t AS (SELECT doc_id, p < round_even(n * (CAST(1 AS DOUBLE) - CAST(0.3 AS DOUBLE)), 0)
        AS in_train FROM r),
      {rank_cte('r2', '(SELECT doc_id FROM t WHERE in_train)', '7/labeled')},
      part AS (SELECT t.doc_id, CASE
          WHEN r2.p < round_even(r2.n * CAST(0.2 AS DOUBLE), 0) THEN 'labeled'
          WHEN t.in_train THEN 'unlabeled' ELSE 'test' END AS part
        FROM t LEFT JOIN r2 USING (doc_id)),
      lab AS (SELECT b.tokens, CAST(b.label AS DOUBLE) AS p, CAST(1.0 AS DOUBLE) AS lam
        FROM base b JOIN part USING (doc_id) WHERE part = 'labeled'),
      {nb_fit_cte('m', 'lab')},
      unl AS (SELECT b.doc_id, b.tokens FROM base b JOIN part USING (doc_id)
        WHERE part = 'unlabeled'),
      {nb_score_cte('u', 'm', 'unl')},
      soft AS (SELECT doc_id, round(1.0 / (1.0 + exp(-greatest(least(score, 30.0), -30.0))), 6) AS p
        FROM sc_u),
      train2 AS (SELECT tokens, p, lam FROM lab
        UNION ALL SELECT u.tokens, s.p, CAST(1.0 AS DOUBLE) FROM unl u JOIN soft s USING (doc_id)),
      {nb_fit_cte('m2', 'train2')},
      tst AS (SELECT b.doc_id, b.tokens FROM base b JOIN part USING (doc_id) WHERE part = 'test'),
      {nb_score_cte('t', 'm2', 'tst')},
      j AS (SELECT CAST(score > 0 AS INTEGER) AS pred, b.label FROM sc_t JOIN base b USING (doc_id))
      SELECT {ACCURACY} FROM j""",
    "cosine": f"""SELECT vec_id, round({COS.format(a='v', b='list_reverse(v)')}, 9) AS cosine
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""",
    "nearest_word_k": f"""{VOCAB_VEC},
      q AS (SELECT vec_id AS qid, CAST(embedding AS DOUBLE[]) AS qv FROM emb WHERE role = 'fake'),
      s AS (SELECT q.qid, vv.id AS word_id, vv.word, {COS.format(a='q.qv', b='vv.vec')} AS sim
        FROM q, vv),
      k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, word_id) - 1 AS rank
        FROM s)
      SELECT qid, CAST(rank AS INTEGER) AS rank, word_id, word, round(sim, 6) AS sim FROM k
      WHERE rank < 3""",
    "step_window_acc": f"""WITH {STEPS},
      rk AS (SELECT *, event_id % (bs + 1) AS correct,
          row_number() OVER (PARTITION BY epoch ORDER BY ts, event_id) - 1 AS r FROM st)
      SELECT epoch, CAST(r // 50 AS BIGINT) AS "window", CAST(sum(bs) AS BIGINT) AS samples,
        round(sum(CAST(correct AS DOUBLE)) / sum(CAST(bs AS DOUBLE)), 9) AS acc
      FROM rk GROUP BY epoch, r // 50""",
}

# Sources and sinks: the round trip must give back the table it started from.
ORACLE.update({
    "review_csv": """SELECT d.doc_id AS id, d.text AS review,
        CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment
      FROM documents d JOIN labels l USING (doc_id)""",
    "test_csv": f"""SELECT doc_id AS id, text AS review FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "member_files": ORACLE["ensemble_submission"],
    "encoded_csv": f"""{LOOKUP} SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row,
        CAST(list_resize(ids, {SEQ_LEN}, -1) AS INTEGER[]) AS ids FROM lk""",
    "vocab_text": f"""WITH {TOKS}, {vocab_cte()}
      SELECT CAST(row_number() OVER (ORDER BY v.id) - 1 AS INTEGER) AS id, v.word,
        e.embedding AS vector FROM vocab v JOIN embeddings e ON e.vec_id = v.id""",
    "cached_split": ORACLE["split_three"],
    "metrics_log": ORACLE["metrics_long"],
    "saved_model_score": ORACLE["nb_score"],
    "stream_nb_score": ORACLE["nb_score"],
    "split_use_all": """SELECT doc_id, 'train' AS part FROM documents JOIN labels USING (doc_id)""",
    "corpus_csv": """SELECT CAST(row_number() OVER (ORDER BY d.doc_id) - 1 AS BIGINT) AS id,
        d.text AS review,
        CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment
      FROM documents d JOIN labels l USING (doc_id)""",
    "member_folders": ORACLE["ensemble_submission"],
    "encoded_parts": f"""{LOOKUP} SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT)
        AS row, CAST(list_resize(ids, {SEQ_LEN}, -1) AS INTEGER[]) AS ids, l.quality AS label
      FROM lk JOIN labels l USING (doc_id)""",
    "lookup_ids_shuffled": ORACLE["lookup_ids"],
    "embed_tokens_shuffled": ORACLE["embed_tokens"],
    "nb_score_shuffled": ORACLE["nb_score"],
    "nearest_word_blocked": ORACLE["nearest_word"],
})
