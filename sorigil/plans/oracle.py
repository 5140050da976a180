"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views. The SQL
is written independently of the Spark plans: Hangul derivation uses ``chr``,
jamo decomposition uses code-point arithmetic on ``unicode``, UTF-8 bytes are
computed from code points, and so on.
"""

from __future__ import annotations

from sorigil.functions.jamo import FINALS, INITIALS, MEDIALS


def hangulize_sql(e: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({e}, ''), lambda c: CASE WHEN unicode(c) BETWEEN 65 AND 90 "
        f"OR unicode(c) BETWEEN 97 AND 122 OR unicode(c) BETWEEN 192 AND 255 "
        f"THEN chr(44032 + (unicode(c) * 2741) % 11172) ELSE c END), '')"
    )


def jamo_sql(e: str) -> str:
    s = "(unicode(c) - 44032)"
    return (
        f"array_to_string(list_transform(string_split({e}, ''), lambda c: CASE WHEN unicode(c) BETWEEN 44032 AND 55203 "
        f"THEN substr('{INITIALS}', {s} // 588 + 1, 1) || substr('{MEDIALS}', ({s} % 588) // 28 + 1, 1) "
        f"|| CASE WHEN {s} % 28 > 0 THEN substr('{FINALS}', {s} % 28, 1) ELSE '' END ELSE c END), '')"
    )


def words_sql(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '[ \\t\\n\\r\\f]+'), lambda w: length(w) > 0)"


def utf8_bytes_sql(e: str) -> str:
    cp = "unicode(c)"
    return (
        f"CASE WHEN {e} = '' THEN []::INTEGER[] ELSE flatten(list_transform(string_split({e}, ''), lambda c: CASE "
        f"WHEN {cp} < 128 THEN [{cp}] "
        f"WHEN {cp} < 2048 THEN [192 + {cp} // 64, 128 + {cp} % 64] "
        f"WHEN {cp} < 65536 THEN [224 + {cp} // 4096, 128 + ({cp} // 64) % 64, 128 + {cp} % 64] "
        f"ELSE [240 + {cp} // 262144, 128 + ({cp} // 4096) % 64, 128 + ({cp} // 64) % 64, 128 + {cp} % 64] END)) END"
    )


ORACLE: dict[str, str] = {}

ORACLE["jamo_words"] = f"""
WITH w AS (SELECT unnest({words_sql('text')}) AS w FROM documents)
SELECT '▁' || {jamo_sql(hangulize_sql('w'))} AS word, count(*) AS n
FROM w GROUP BY 1
"""

META = """SELECT doc_id, source, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS source_ord,
  printf('doc_%06d.wav', doc_id) AS filename, '/data/' || source || '/wavs/' || printf('doc_%06d.wav', doc_id) AS full_path,
  text AS raw_text FROM documents"""
KEPT = f"""SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_idx,
  row_number() OVER (ORDER BY source_ord, doc_id) - 1 AS pos
  FROM ({META}) m WHERE full_path IN (SELECT '/data/' || d.source || '/wavs/' || printf('doc_%06d.wav', d.doc_id)
  FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels))"""
BATCH_SIZE = 8
MAX_SAMPLES = 300

ORACLE["jamo_metadata"] = f"""
SELECT printf('doc_%06d.wav', doc_id) AS filename, {hangulize_sql('text')} AS text, {jamo_sql(hangulize_sql('text'))} AS jamo
FROM documents
"""

ORACLE["source_concat"] = f"""
SELECT doc_id, source, source_ord, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_idx,
  row_number() OVER (ORDER BY source_ord, doc_id) - 1 AS pos, filename, full_path
FROM ({META}) m
"""

ORACLE["batch_assign"] = f"SELECT doc_id, pos, pos // {BATCH_SIZE} AS batch_id FROM ({KEPT}) k"

ORACLE["max_samples"] = f"SELECT doc_id, source, pos FROM ({KEPT}) k WHERE pos < {MAX_SAMPLES}"

ORACLE["with_audio"] = f"SELECT doc_id, source, row_idx, pos, full_path FROM ({KEPT}) k"

ORACLE["missing_audio"] = f"""
SELECT doc_id, source, full_path FROM ({META}) m WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""

ORACLE["source_counts"] = f"""
SELECT source, count(*) AS n_before, count(l.doc_id) AS n_after, count(*) - count(l.doc_id) AS n_missing
FROM ({META}) m LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)
GROUP BY ROLLUP (source)
"""

ORACLE["progress"] = f"""
WITH k AS ({KEPT}),
b AS (SELECT pos // {BATCH_SIZE} AS batch_id, count(*) AS n_rows,
        sum(CASE WHEN length({jamo_sql(hangulize_sql('raw_text'))}) > 0 THEN 1 ELSE 0 END)::BIGINT AS n_valid FROM k GROUP BY 1)
SELECT batch_id, least((batch_id + 1) * {BATCH_SIZE}, (SELECT count(*) FROM k)) AS batch_end,
  (SELECT count(*) FROM k) AS total, n_valid, (sum(n_valid) OVER (ORDER BY batch_id))::BIGINT AS valid_so_far
FROM b
"""

# ---- encoding and batches ---------------------------------------------------
EPOCHS = 2
PREVIEW = 10
TEXT_LENGTH = 1024
AUDIO_PAD = 1025
COLLATE_AUDIO_LEN = 12
LOSS_BATCH = 4
LOGIT_PAD = 9

ENCODED = f"SELECT doc_id, pos, {utf8_bytes_sql(jamo_sql(hangulize_sql('raw_text')))} AS tok FROM ({KEPT}) k"

ORACLE["encode_bytes"] = f"""
SELECT pos AS original_indices, len(tok)::INTEGER AS n_tokens, array_to_string(tok[1:{PREVIEW}], ',') AS preview,
  array_to_string(tok, ',') AS text_tokens
FROM ({ENCODED}) e
"""

ORACLE["speaker_tag"] = f"""
SELECT conv_id, turn, CASE WHEN starts_with(j, '[S1]') OR starts_with(j, '[S2]') THEN j ELSE '[S1] ' || j END AS text
FROM (SELECT conv_id, turn, {jamo_sql("CASE WHEN turn % 2 = 1 THEN '[S2] ' || " + hangulize_sql('text') + " WHEN turn % 4 = 0 THEN '[S1] ' || " + hangulize_sql('text') + " ELSE " + hangulize_sql('text') + " END")} AS j
      FROM conversations) c
"""

def _feistel_sql(src: str) -> str:
    """``pos, epoch, n, x``: x of ``src`` passed once through six keyed rounds on x = l * b + r, a near-square of at least n places."""
    out = f"SELECT pos, epoch, n, a, b, x // b AS l, x % b AS r FROM (SELECT *, (n + a - 1) // a AS b FROM (SELECT pos, epoch, n, x, ceil(sqrt(n::DOUBLE))::BIGINT AS a FROM ({src}) q0) q1) q2"
    for i in range(6):
        key = f"(('0x' || substr(md5('0:' || epoch || ':{i}'), 1, 8))::BIGINT % 2147483647)"
        other, mine, side = ("r", "l", "a") if i % 2 == 0 else ("l", "r", "b")
        y = f"(({other} + {key}) % 2147483647)"
        cube = f"({y} * {y} % 2147483647 * {y} % 2147483647)"
        out = f"SELECT pos, epoch, n, a, b, {other}, ({mine} + {cube} % {side}) % {side} AS {mine} FROM ({out}) r{i}"
    return f"SELECT pos, epoch, n, l * b + r AS x FROM ({out}) done"


SHUFFLED = f"""SELECT e.*, p.epoch, p.x AS shuffled_pos FROM ({{src}}) e JOIN (
  WITH RECURSIVE walk AS (
    {_feistel_sql("SELECT i.pos, ep.epoch, i.n, i.x FROM (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS x, count(*) OVER () AS n FROM ({{src}}) s) i, (SELECT unnest(range({{epochs}}))::INTEGER AS epoch) ep").replace("{{", "{").replace("}}", "}")}
    UNION ALL {_feistel_sql("SELECT pos, epoch, n, x FROM walk WHERE x >= n")}
  ) SELECT pos, epoch, x FROM walk WHERE x < n) p USING (pos)"""

ORACLE["shuffle_epoch"] = f"""
SELECT epoch, pos, shuffled_pos, shuffled_pos // {BATCH_SIZE} AS batch_id
FROM ({SHUFFLED.format(src=f"SELECT pos FROM ({KEPT}) k", epochs=EPOCHS)}) s
"""

ORACLE["collate_text"] = f"""
WITH s AS (SELECT *, shuffled_pos // {BATCH_SIZE} AS batch_id FROM ({SHUFFLED.format(src=ENCODED, epochs=EPOCHS)}) q),
b AS (SELECT *, least(max(len(tok)) OVER (PARTITION BY epoch, batch_id), {TEXT_LENGTH}) AS batch_len FROM s),
p AS (SELECT *, (tok || list_transform(range(greatest(batch_len - len(tok), 0)), lambda i: 0))[1:batch_len] AS padded FROM b)
SELECT epoch, batch_id, pos, batch_len::INTEGER AS batch_len, array_to_string(padded, ',') AS padded,
  len(list_filter(padded, lambda v: v <> 0))::INTEGER AS n_unmasked, len(tok)::INTEGER AS n_attention,
  array_to_string(range(batch_len), ',') AS positions
FROM p
"""

CODES = """list_transform(range(greatest(len(embedding) // 4 - label, 0)),
  lambda t: list_transform(embedding[t * 4 + 1 : t * 4 + 4], lambda x: floor((x::DOUBLE + 1) * 8)::INTEGER))"""

ORACLE["collate_audio"] = f"""
WITH s AS (SELECT *, shuffled_pos // {BATCH_SIZE} AS batch_id
           FROM ({SHUFFLED.format(src=f"SELECT vec_id AS pos, {CODES} AS tok FROM embeddings", epochs=1)}) q),
b AS (SELECT *, least(max(len(tok)) OVER (PARTITION BY batch_id), {COLLATE_AUDIO_LEN}) AS batch_len FROM s),
p AS (SELECT *, (tok || list_transform(range(greatest(batch_len - len(tok), 0)), lambda i: [{AUDIO_PAD}, {AUDIO_PAD}, {AUDIO_PAD}, {AUDIO_PAD}]))[1:batch_len] AS padded FROM b)
SELECT batch_id, pos AS clip_id, batch_len::INTEGER AS batch_len,
  array_to_string(list_transform(padded, lambda r: array_to_string(r, ',')), ';') AS padded
FROM p
"""

ORACLE["paired_rows"] = f"""
SELECT pos // {BATCH_SIZE} AS batch_id, pos, copy::INTEGER AS copy, (2 * (pos % {BATCH_SIZE}) + copy)::BIGINT AS slot_k, copy = 0 AS kept
FROM (SELECT pos, unnest(range(2)) AS copy FROM ({KEPT}) k) d
"""

ORACLE["clip_names"] = """
SELECT vec_id AS clip_id, (row_number() OVER (ORDER BY vec_id) - 1)::BIGINT AS idx,
  printf('zeroth_%06d.wav', row_number() OVER (ORDER BY vec_id) - 1) AS filename
FROM embeddings
"""

ORACLE["channel_loss"] = f"""
WITH lg AS (SELECT vec_id // 16 AS seq_id, vec_id % 16 AS t, c AS channel,
              list_transform(embedding[c * 16 + 1 : c * 16 + 16], lambda v: v::DOUBLE) AS logits, (label + c) % 16 AS label
            FROM embeddings, (SELECT unnest(range(4))::INTEGER AS c) ch),
pr AS (SELECT *, lead(label) OVER (PARTITION BY seq_id, channel ORDER BY t) AS target FROM lg),
pairs AS (SELECT seq_id // {LOSS_BATCH} AS batch_id, channel, logits, target, list_max(logits) AS m FROM pr WHERE target IS NOT NULL),
ce AS (SELECT batch_id, channel, m + ln(list_sum(list_transform(logits, lambda v: exp(v - m)))) - logits[target + 1] AS ce
       FROM pairs WHERE target <> {LOGIT_PAD}),
pc AS (SELECT d.batch_id, d.channel, avg(ce.ce) AS loss, count(ce.ce) AS n_tokens
       FROM (SELECT DISTINCT batch_id, channel FROM pairs) d LEFT JOIN ce USING (batch_id, channel) GROUP BY 1, 2)
SELECT batch_id, round(avg(loss), 6) AS loss, count(loss) AS n_channels, coalesce(sum(n_tokens), 0)::BIGINT AS n_tokens
FROM pc GROUP BY 1
"""

# ---- run log ----------------------------------------------------------------
ACCUM = 4
LOG_EVERY = 10
RUN_LOG = "SELECT event_id, epoch_us(ts) AS ts_us, (epoch_us(ts) // 86400000000)::INTEGER AS epoch, value AS loss FROM events"

ORACLE["epoch_metrics"] = f"""
SELECT epoch, count(*) AS n_steps, round(avg(loss), 6) AS avg_loss, count(*) // {ACCUM} AS optimizer_steps,
  count(*) % {ACCUM} AS pending, round((max(ts_us) - min(ts_us)) / 1e6, 6) AS elapsed_sec
FROM ({RUN_LOG}) r GROUP BY epoch
"""

ORACLE["step_counters"] = f"""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY ts_us, event_id) - 1 AS step FROM ({RUN_LOG}) r),
e AS (SELECT epoch, count(*) AS n FROM s GROUP BY epoch),
pe AS (SELECT epoch, coalesce(sum(n // {ACCUM}) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_opt,
         sum(n) OVER () AS total FROM e)
SELECT s.epoch, step, round(loss, 6) AS loss, (step + 1) // {ACCUM} AS epoch_opt_step,
  (prev_opt + (step + 1) // {ACCUM})::BIGINT AS global_opt_step, total::BIGINT AS total_micro_steps
FROM s JOIN pe USING (epoch) WHERE (step + 1) % {LOG_EVERY} = 0
"""

# ---- waveforms ----------------------------------------------------------------
TRIM_THRESHOLD = 0.3
RESAMPLE_TO = 24
CLIPS = """SELECT vec_id AS clip_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x,
  CASE WHEN vec_id % 2 = 0 THEN 16 ELSE 32 END AS rate FROM embeddings"""


def long_form(src: str) -> str:
    return f"""SELECT clip_id, i::INTEGER AS i, round(y[i + 1], 6) + 0.0 AS v
FROM (SELECT clip_id, y, unnest(range(len(y))) AS i FROM ({src}) q) u"""


def interp_sql(x: str, n: str, m: str) -> str:
    xi = f"(i * (({n} - 1)::DOUBLE / ({m} - 1)::DOUBLE))"
    lo = f"least(floor({xi})::INTEGER, {n} - 1)"
    hi = f"least({lo} + 1, {n} - 1)"
    return (
        f"CASE WHEN {m} = 1 THEN [{x}[1]] ELSE list_transform(range({m}), lambda i: "
        f"{x}[{lo} + 1] + ({xi} - {lo}) * ({x}[{hi} + 1] - {x}[{lo} + 1])) END"
    )


ORACLE["trim_tail"] = long_form(f"""
SELECT clip_id, CASE WHEN len(x) = 0 OR last < 0 THEN x ELSE x[1:least(last + floor(rate * 0.5)::INTEGER, len(x))] END AS y
FROM (SELECT *, list_max(list_transform(range(len(x)), lambda i: CASE WHEN abs(x[i + 1]) > {TRIM_THRESHOLD} THEN i ELSE -1 END)) AS last
      FROM ({CLIPS}) c) t
""")

ORACLE["change_speed"] = long_form(f"""
SELECT clip_id, list_transform(CASE WHEN f_raw = 1.0 OR m = n OR m <= 0 OR n = 0 THEN x ELSE {interp_sql('x', 'n', 'm')} END,
  lambda v: greatest(-1.0, least(1.0, v))) AS y
FROM (SELECT *, floor(n / f)::INTEGER AS m
      FROM (SELECT *, len(x) AS n, greatest(0.1, least(f_raw, 5.0)) AS f
            FROM (SELECT *, 0.5::DOUBLE + 0.25::DOUBLE * label AS f_raw FROM ({CLIPS}) c) c1) c2) c3
""")

_HALF = f"(16.0 / least(1.0, {RESAMPLE_TO}::DOUBLE / rate))"
_T = f"(j * rate::DOUBLE / {RESAMPLE_TO})"
_KERNEL = f"""least(1.0, {RESAMPLE_TO}::DOUBLE / rate) * CASE WHEN abs({_T} - k) < 1e-12 THEN 1.0
  ELSE sin(pi() * least(1.0, {RESAMPLE_TO}::DOUBLE / rate) * ({_T} - k)) / (pi() * least(1.0, {RESAMPLE_TO}::DOUBLE / rate) * ({_T} - k)) END
  * (0.5 + 0.5 * cos(pi() * ({_T} - k) / {_HALF}))"""
ORACLE["resample"] = f"""
SELECT clip_id, i::INTEGER AS i, round(y, 6) + 0.0 AS v FROM (
  SELECT clip_id, j AS i, list_sum(list_transform(range(greatest(ceil({_T} - {_HALF}), 0)::BIGINT, least(floor({_T} + {_HALF}), n - 1)::BIGINT + 1), lambda k: x[k + 1] * {_KERNEL})) AS y
  FROM (SELECT clip_id, rate, x, len(x) AS n, unnest(range(ceil(len(x) * {RESAMPLE_TO}::DOUBLE / rate)::BIGINT)) AS j FROM ({CLIPS}) c WHERE rate <> {RESAMPLE_TO}) q
  UNION ALL
  SELECT clip_id, i, x[i + 1] FROM (SELECT clip_id, x, unnest(range(len(x))) AS i FROM ({CLIPS}) c WHERE rate = {RESAMPLE_TO}) q
) u
"""

AMIN_SQ = repr(1e-5 * 1e-5)
ORACLE["to_db"] = long_form(f"""
SELECT clip_id, list_transform(db, lambda v: greatest(v, list_max(db) - 80.0)) AS y
FROM (SELECT clip_id, list_transform(sq, lambda v: 10.0 * log10(greatest({AMIN_SQ}, v)) - 10.0 * log10(greatest({AMIN_SQ}, r))) AS db
      FROM (SELECT clip_id, sq, list_max(sq) AS r FROM (SELECT clip_id, list_transform(x, lambda v: v * v) AS sq FROM ({CLIPS}) c) c1) c2) c3
""")

ORACLE["to_mono"] = long_form(f"""
SELECT clip_id, list_transform(range(len(x) // 2), lambda i: (x[i + 1] + x[i + 1 + len(x) // 2]) / 2) AS y FROM ({CLIPS}) c
""")

ORACLE["clip_duration"] = f"""
SELECT label, count(*) AS n_clips, round(sum(len(x) / rate::DOUBLE), 6) AS total_sec FROM ({CLIPS}) c GROUP BY label
"""

# ---- spectral features ----------------------------------------------------------
FEAT_N_FFT, FEAT_HOP, FEAT_N_MELS = 16, 4, 4


def _spectrum_sql(with_mel: bool, scaled: int | None = None) -> str:
    n, hop, half = FEAT_N_FFT, FEAT_HOP, FEAT_N_FFT // 2
    win = f"(0.5 - 0.5 * cos(2 * pi() * k / {n}))"
    re = f"list_sum(list_transform(range({n}), lambda k: fx[k + 1] * {win} * cos(2 * pi() * j * k / {n})))"
    im = f"list_sum(list_transform(range({n}), lambda k: fx[k + 1] * {win} * sin(2 * pi() * j * k / {n})))"
    zeros = f"list_transform(range({half}), lambda i: 0.0::DOUBLE)"
    power = f"""SELECT clip_id, rate, f AS frame, j AS bin, pow({re}, 2) + pow({im}, 2) AS p
FROM (SELECT clip_id, rate, f, xp[f * {hop} + 1 : f * {hop} + {n}] AS fx, unnest(range({half} + 1)) AS j
      FROM (SELECT clip_id, rate, xp, unnest(range(1 + (len(xp) - {n}) // {hop})) AS f
            FROM (SELECT clip_id, rate, list_concat({zeros}, x, {zeros}) AS xp FROM ({CLIPS}) c) c1) c2) c3"""
    if with_mel:
        # edges of the triangles, evenly spaced in mel (linear below 1 kHz, logarithmic above)
        knee, step = "(1000.0 / (200.0 / 3))", "(ln(6.4) / 27.0)"
        to_mel = f"CASE WHEN h < 1000 THEN h / (200.0 / 3) ELSE {knee} + ln(h / 1000.0) / {step} END"
        to_hz = f"CASE WHEN m < {knee} THEN m * (200.0 / 3) ELSE 1000.0 * exp({step} * (m - {knee})) END"
        fb = f"""(SELECT rate, mel, bin, greatest(0.0, least((f - e0) / (e1 - e0), (e2 - f) / (e2 - e1))) * 2.0 / (e2 - e0) AS w
FROM (SELECT rate, i AS mel, hz AS e0, lead(hz, 1) OVER (PARTITION BY rate ORDER BY i) AS e1, lead(hz, 2) OVER (PARTITION BY rate ORDER BY i) AS e2
      FROM (SELECT rate, i, {to_hz} AS hz FROM (SELECT rate, i, i * ({to_mel}) / {FEAT_N_MELS + 1} AS m
            FROM (SELECT rate, rate / 2.0::DOUBLE AS h, unnest(range({FEAT_N_MELS + 2})) AS i FROM (VALUES (16), (32)) r(rate)) a) b) c) d,
     (SELECT rate AS r2, j AS bin, j * rate / {n}::DOUBLE AS f FROM (VALUES (16), (32)) r(rate), (SELECT unnest(range({half} + 1)) AS j) q) g
WHERE r2 = rate AND e2 IS NOT NULL) fb"""
        power = f"""SELECT s.clip_id, s.frame, fb.mel AS bin, sum(s.p * fb.w) AS p
FROM ({power}) s JOIN {fb} ON s.rate = fb.rate AND s.bin = fb.bin GROUP BY 1, 2, 3"""
    z = "(d - mu) / (sd + 1e-5)"
    value = f"round({z} * {scaled})::BIGINT" if scaled else f"round({z}, 6) + 0.0"
    return f"""
WITH sp AS ({power}),
r AS (SELECT clip_id, max(p) AS ref FROM sp GROUP BY 1),
db AS (SELECT sp.clip_id, frame, bin, greatest(10 * log10(greatest(1e-10, p)) - 10 * log10(greatest(1e-10, ref)), -80.0) AS d
       FROM sp JOIN r USING (clip_id)),
st AS (SELECT clip_id, avg(d) AS mu, stddev_pop(d) AS sd FROM db GROUP BY 1)
SELECT clip_id, frame::INTEGER AS frame, bin::INTEGER AS bin, {value} AS v FROM db JOIN st USING (clip_id)
"""


ORACLE["spectrum_db"] = _spectrum_sql(False)
ORACLE["mel_features"] = _spectrum_sql(True)

# ---- vocabulary -----------------------------------------------------------------
VOCAB_SIZE = 8000
SEED_TOP = 32_000
JAMO_WORDS = f"""SELECT '▁' || {jamo_sql(hangulize_sql('w'))} AS word, count(*) AS n
FROM (SELECT unnest({words_sql('text')}) AS w FROM documents) x GROUP BY 1"""

SEEDS = f"""
jw AS ({JAMO_WORDS}),
st AS (SELECT word, n, unnest(range(length(word))) AS b FROM jw),
win AS (SELECT substr(word, b + 1, 16) AS w, b = 0 AS first, sum(n) AS n FROM st GROUP BY ALL),
sk AS (SELECT w, first, n, unnest(range(1, length(w) + 1)) AS k FROM win),
agg AS (SELECT substr(w, 1, k) AS piece, sum(n)::BIGINT AS n FROM sk
        WHERE first OR strpos(substr(w, 1, k), '▁') = 0 GROUP BY 1),
seeds AS (SELECT piece, n, length(piece)::INTEGER AS len FROM agg WHERE n >= 2 OR length(piece) = 1),
top AS ((SELECT * FROM seeds WHERE len > 1 ORDER BY n * len DESC, piece LIMIT {SEED_TOP})
        UNION ALL (SELECT * FROM seeds WHERE len = 1))"""

VOCAB = f"""
{SEEDS},
tot AS (SELECT sum(n) AS t FROM top),
sc AS (SELECT piece, round(ln(n) - ln(t), 6) AS score FROM top, tot),
best AS (SELECT piece, score FROM sc ORDER BY length(piece) = 1 DESC, score DESC, piece LIMIT {VOCAB_SIZE - 4}),
ranked AS (SELECT (row_number() OVER (ORDER BY score DESC, piece) + 3)::INTEGER AS id, piece, score FROM best),
vocab AS (SELECT * FROM ranked UNION ALL
          SELECT * FROM (VALUES (0, '<pad>', 0.0::DOUBLE), (1, '<unk>', 0.0::DOUBLE), (2, '<s>', 0.0::DOUBLE), (3, '</s>', 0.0::DOUBLE)) v(id, piece, score))"""

ORACLE["char_coverage"] = f"""
WITH jw AS ({JAMO_WORDS}),
c AS (SELECT ch AS char, sum(n)::BIGINT AS n FROM (SELECT unnest(string_split(word, '')) AS ch, n FROM jw) q GROUP BY 1)
SELECT char, n, (row_number() OVER (ORDER BY n DESC, char))::INTEGER AS rank,
  round(sum(n) OVER (ORDER BY n DESC, char ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER (), 6) AS share,
  true AS kept
FROM c
"""

ORACLE["seed_pieces"] = f"WITH {SEEDS} SELECT piece, n, len FROM top"

ORACLE["rank_vocab"] = f"WITH {VOCAB} SELECT id, piece, score FROM vocab"

ORACLE["decode_ids"] = f"""
WITH {VOCAB},
known AS (SELECT list(piece) AS k FROM vocab WHERE id >= 4 AND length(piece) = 1),
bw AS (SELECT item_id, {words_sql(jamo_sql(hangulize_sql('text')))} AS ws FROM benchmark)
SELECT item_id, ltrim(replace(array_to_string(list_transform(ws, lambda x: array_to_string(
    list_transform(string_split('▁' || x, ''), lambda c: CASE WHEN list_contains(k, c) THEN c ELSE '<unk>' END), '')), ''),
  '▁', ' ')) AS text
FROM bw, known
"""


def segment_sql(words: str) -> str:
    """CTEs after ``VOCAB`` ending in ``seg(word, pieces, ids, score)``: best split of every
    distinct word of the CTE ``words`` (column ``word``).

    Viterbi as a recursive query, one step per character: the edges ending at
    position e (vocabulary pieces, or an unknown edge where no one-character
    piece exists) are gathered per (word, e); a step extends every word's
    best-score list by the best edge, ties to the smallest begin. A second
    recursion walks the back pointers."""
    return f"""
pv AS MATERIALIZED (SELECT piece, id, score FROM vocab WHERE id >= 4),
unk AS (SELECT min(score) - 10.0 AS u FROM pv),
wb AS (SELECT word, unnest(range(length(word))) AS b FROM {words}),
wk AS (SELECT word, b, unnest(range(1, least(16, length(word) - b) + 1)) AS k FROM wb),
hit AS (SELECT wk.word, wk.b + wk.k AS e, wk.b, pv.id, pv.score FROM wk JOIN pv ON pv.piece = substr(wk.word, wk.b + 1, wk.k)),
miss AS (SELECT wb.word, wb.b + 1 AS e, wb.b, 1 AS id, unk.u AS score FROM wb, unk
         WHERE substr(wb.word, wb.b + 1, 1) NOT IN (SELECT piece FROM pv)),
edges AS MATERIALIZED (SELECT word, e, list({{'b': b, 'id': id, 's': score}}) AS ed
         FROM (SELECT * FROM hit UNION ALL SELECT * FROM miss) x GROUP BY word, e),
dp AS MATERIALIZED (SELECT * FROM (WITH RECURSIVE r(word, e, best, back, bid) USING KEY (word) AS (
    SELECT word, 0, [0.0::DOUBLE], []::INTEGER[], []::INTEGER[] FROM {words}
    UNION
    SELECT r.word, r.e + 1, list_append(r.best, c.top.v), list_append(r.back, c.top.b::INTEGER),
      list_append(r.bid, c.top.id::INTEGER)
    FROM r JOIN edges g ON g.word = r.word AND g.e = r.e + 1,
    LATERAL (SELECT list_sort(list_transform(g.ed, lambda x: {{'v': r.best[x.b + 1] + x.s, 'nb': -x.b, 'b': x.b, 'id': x.id}}),
             'DESC')[1] AS top) c
  ) SELECT * FROM r)),
bt AS (SELECT * FROM (WITH RECURSIVE t(word, pos, pieces, ids) USING KEY (word) AS (
    SELECT word, e, []::VARCHAR[], []::INTEGER[] FROM dp
    UNION
    SELECT t.word, d.back[t.pos], list_prepend(substr(t.word, d.back[t.pos] + 1, t.pos - d.back[t.pos]), t.pieces),
      list_prepend(d.bid[t.pos], t.ids)
    FROM t JOIN dp d USING (word) WHERE t.pos > 0
  ) SELECT * FROM t)),
seg AS (SELECT word, pieces, ids, d.best[d.e + 1] AS score FROM bt JOIN dp d USING (word))"""


ORACLE["segment_words"] = f"""
WITH {VOCAB},{segment_sql('jw')}
SELECT word, array_to_string(pieces, ' ') AS pieces, array_to_string(ids, ',') AS ids, round(score, 6) AS score FROM seg
"""

# texts as positioned words: (key, wpos, word)
BENCH_WORDS = f"""SELECT item_id, unnest(ws) AS w, unnest(range(len(ws))) AS wpos
  FROM (SELECT item_id, {words_sql(jamo_sql(hangulize_sql('text')))} AS ws FROM benchmark) b"""

ORACLE["encode_texts"] = f"""
WITH {VOCAB},
bw AS (SELECT item_id, wpos, '▁' || w AS word FROM ({BENCH_WORDS}) q),
bwd AS (SELECT DISTINCT word FROM bw),{segment_sql('bwd')},
enc AS (SELECT item_id, flatten(list(s.pieces ORDER BY wpos)) AS pieces, flatten(list(s.ids ORDER BY wpos)) AS ids
        FROM bw JOIN seg s USING (word) GROUP BY item_id)
SELECT b.item_id, coalesce(len(e.ids), 0)::INTEGER AS n_tokens, coalesce(array_to_string(e.pieces, ' '), '') AS pieces,
  coalesce(array_to_string(e.ids, ','), '') AS ids
FROM benchmark b LEFT JOIN enc e USING (item_id)
"""

DOC_WORDS = f"""SELECT doc_id, '▁' || unnest({words_sql(jamo_sql(hangulize_sql('text')))}) AS word FROM documents"""

ORACLE["token_stats"] = f"""
WITH {VOCAB},{segment_sql('jw')},
per_text AS (SELECT d.doc_id, d.source, coalesce(sum(len(s.ids)), 0) AS n,
               coalesce(sum(len(list_filter(s.ids, lambda i: i = 1))), 0) AS u
             FROM documents d LEFT JOIN ({DOC_WORDS}) w USING (doc_id) LEFT JOIN seg s USING (word)
             GROUP BY d.doc_id, d.source)
SELECT source, count(*) AS n_texts, round(avg(n), 6) AS avg_tokens, max(n)::INTEGER AS max_tokens,
  list_sort(list(n))[ceil(count(*) / 2)::BIGINT]::INTEGER AS median_tokens, round(sum(u) / sum(n), 6) AS unk_rate
FROM per_text GROUP BY source
"""

# ---- through files ----------------------------------------------------------------
ORACLE["file_concat"] = f"""
SELECT filename, {hangulize_sql('raw_text')} AS text, '/data/' || source || '/' AS data_dir, source,
  (dense_rank() OVER (ORDER BY source_ord) - 1)::INTEGER AS source_ord, full_path FROM ({META}) m
"""
ORACLE["file_chosen"] = f"SELECT source, filename FROM ({META}) m WHERE source IN ('src1', 'src3', 'src11')"
_LINE = "regexp_replace(text, '[\\r\\n]+', ' ', 'g')"
_QUOTED = "(length(raw) >= 2 AND raw[1] = chr(34) AND raw[-1] = chr(34))"
_UNDONE = "replace(replace(replace(replace(replace(p, '\\n', chr(10)), '\\r', chr(13)), '\\q', chr(34)), '\\0', chr(0)), '\\1', chr(1))"
_FITS = "(raw NOT LIKE '%|%' OR regexp_full_match(raw, '\"[^\"]*\"'))"
ORACLE["file_rejects"] = f"""
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '"' || {_LINE} || '"' ELSE {_LINE} END AS raw FROM documents)
SELECT CASE WHEN {_FITS} THEN printf('doc_%06d.wav', doc_id) END AS filename,
  CASE WHEN NOT {_FITS} THEN printf('doc_%06d.wav', doc_id) || '|' || raw
    WHEN {_QUOTED} THEN array_to_string(list_transform(string_split(raw[2:-2], '\\\\'), lambda p: {_UNDONE}), '\\')
    ELSE nullif(raw, '') END AS text, NOT {_FITS} AS rejected
FROM r
"""
ORACLE["file_corpus"] = f"SELECT regexp_replace({jamo_sql(hangulize_sql('text'))}, '[\\r\\n]+', ' ', 'g') AS line FROM documents"
ORACLE["file_listing"] = f"SELECT source, sum(strlen({_LINE}) + 1)::BIGINT AS bytes FROM documents GROUP BY source"
ORACLE["file_processed"] = f"""
SELECT d.doc_id,
  CASE WHEN l.doc_id IS NULL THEN '' ELSE array_to_string({utf8_bytes_sql(jamo_sql(hangulize_sql('d.text')))}, ',') END AS tokens,
  CASE WHEN l.doc_id IS NULL THEN '' ELSE l.quality || ',' || l.toxic END AS codes,
  CASE WHEN l.doc_id IS NULL THEN 'audio_tokens failed' ELSE '' END AS reason
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""
ORACLE["file_speech"] = """
SELECT vec_id AS clip_id, vec_id % 2 = 1 AS resample, (i - 1)::INTEGER AS i, embedding[i]::DOUBLE AS v
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) e
"""
ORACLE["file_vocab"] = f"WITH {VOCAB} SELECT f AS format, id, piece, round(score, 6) AS score FROM vocab, (VALUES ('parquet'), ('tsv')) x(f)"
ORACLE["lattice_edges"] = f"""
WITH {VOCAB},
bw AS (SELECT DISTINCT '▁' || w AS word FROM ({BENCH_WORDS}) q),
bb AS (SELECT word, unnest(range(length(word))) AS b FROM bw),
be AS (SELECT word, b, unnest(range(b + 1, least(b + 16, length(word)) + 1)) AS e FROM bb)
SELECT word, b::INTEGER AS b, e::INTEGER AS e, piece, id, round(score, 6) AS score
FROM be JOIN vocab ON piece = substr(word, b + 1, e - b) WHERE id >= 4 AND (b = 0 OR strpos(piece, '▁') = 0)
"""

# ---- training examples: mel rows of the spectrum query regrouped into blocks, next to the encoded texts ----
FEATURE_BLOCK = 8
ORACLE["feature_table"] = f"""
WITH {VOCAB},
bw AS (SELECT item_id, wpos, '▁' || w AS word FROM ({BENCH_WORDS}) q),
bwd AS (SELECT DISTINCT word FROM bw),{segment_sql('bwd')},
enc AS (SELECT item_id, flatten(list(s.ids ORDER BY wpos)) AS ids FROM bw JOIN seg s USING (word) GROUP BY item_id),
items AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS rank, count(*) OVER () AS n FROM benchmark),
mel AS ({_spectrum_sql(True, 10000)}),
fr AS (SELECT clip_id, frame, list(v ORDER BY bin) AS vs FROM mel GROUP BY ALL),
bl AS (SELECT clip_id, frame // {FEATURE_BLOCK} AS block, count(*) AS frames, flatten(list(vs ORDER BY frame)) AS vs FROM fr GROUP BY ALL),
cl AS (SELECT vec_id AS clip_id, len(embedding) // {FEAT_HOP} + 1 AS n_frames FROM embeddings)
SELECT cl.clip_id, bl.block::INTEGER AS block, ((n_frames + {FEATURE_BLOCK - 1}) // {FEATURE_BLOCK})::INTEGER AS n_blocks, n_frames::INTEGER AS n_frames, bl.frames::INTEGER AS frames,
  array_to_string(bl.vs, ',') AS features,
  CASE WHEN bl.block = 0 THEN coalesce(array_to_string(enc.ids, ','), '') END AS input_ids, CASE WHEN bl.block = 0 THEN coalesce(len(enc.ids), 0)::INTEGER END AS n_attention
FROM cl JOIN bl USING (clip_id) JOIN items i ON i.rank = cl.clip_id % i.n LEFT JOIN enc USING (item_id)
"""
ORACLE["channel_loss_blocks"] = ORACLE["channel_loss"]  # the same numbers, whatever the blocks
