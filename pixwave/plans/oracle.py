"""DuckDB SQL with the result each registered query must have."""

# ---- the fixtures as common table expressions ------------------------------------

IMG8 = """img8 AS (SELECT vec_id AS example_id, label::INT AS label,
  list_transform(embedding, lambda v: least(255, greatest(0, floor((v::DOUBLE + 1) * 127.5)::INT))) AS pixels
  FROM embeddings)"""
PX = IMG8 + """, px AS (SELECT example_id, label, generate_subscripts(pixels, 1) - 1 AS i, unnest(pixels)::DOUBLE AS v
  FROM img8)"""
STD = PX + """, stat AS (SELECT example_id, avg(v) AS m, greatest(stddev_pop(v), 1.0 / sqrt(64.0)) AS s FROM px GROUP BY 1),
  std AS (SELECT example_id, label, i, (v - m) / s AS v FROM px JOIN stat USING (example_id))"""
WEIGHT = "(((31 * i + 17 * j) % 23) - 11) / 11.0::DOUBLE"
CLASSES = "cls AS (SELECT range::INT AS j FROM range(10))"
LOGITS = f"""logit AS (SELECT example_id, any_value(label) AS label, j, sum(v * ({WEIGHT})) + j / 1000.0::DOUBLE AS z
  FROM std, cls GROUP BY example_id, j)"""
PRED = STD + ", " + CLASSES + ", " + LOGITS + """, soft AS (SELECT *, z - max(z) OVER w AS zz,
  exp(z - max(z) OVER w) / sum(exp(z - m)) OVER w AS p FROM (SELECT *, max(z) OVER (PARTITION BY example_id) AS m FROM logit)
  WINDOW w AS (PARTITION BY example_id)),
  lse AS (SELECT example_id, any_value(label) AS label, max(m) + ln(sum(exp(z - m))) AS lse, sum(CASE WHEN j = label THEN z END) AS zy,
    arg_max(j, (z, -j)) AS prediction
    FROM (SELECT *, max(z) OVER (PARTITION BY example_id) AS m FROM logit) GROUP BY example_id)"""
SIG = """sig AS (SELECT user_id AS file, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, value
  FROM events)"""
LOG = """log AS (SELECT event_type AS run, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS step,
  ts, value AS loss FROM events)"""
LINES = r"""lines AS (
  SELECT conv_id AS episode, turn + 2 AS line_no, 'Dialogue: 0,' || tc(7 * turn + 0.25) || ',' || tc(7 * turn + 2.75)
    || ',Sub-Jap,,0,0,0,,' || regexp_replace(text, '[\r\n]|,,', ' ', 'g') AS line FROM conversations
  UNION ALL SELECT DISTINCT conv_id, 0, 'Dialogue: 0,Sub-Jap before the marker' FROM conversations
  UNION ALL SELECT DISTINCT conv_id, 1, '; ---Sub-JP----' FROM conversations)"""


def _timecode(s: str) -> str:
    return f"printf('0:%02d:%05.2f', floor(({s}) / 60)::BIGINT, ({s})::DOUBLE - 60 * floor(({s}) / 60))"


LINES = LINES.replace("tc(7 * turn + 0.25)", _timecode("7 * turn + 0.25")).replace(
    "tc(7 * turn + 2.75)", _timecode("7 * turn + 2.75"))
SUBS = LINES + """, marked AS (SELECT episode, min(line_no) AS marker FROM lines WHERE contains(line, '---Sub-JP----') GROUP BY 1),
  subs AS (SELECT episode, line_no, string_split(line, ',,')[3] AS dialogue,
    string_split(string_split(line, ',,')[1], ',')[2] AS start_tc, string_split(string_split(line, ',,')[1], ',')[3] AS end_tc
    FROM lines JOIN marked USING (episode) WHERE line_no > marker AND contains(line, 'Sub-Jap'))"""


def sample(tc: str, fs: int) -> str:
    h, m, s = (f"string_split({tc}, ':')[{k}]" for k in (1, 2, 3))
    return f"(trunc({s}::DOUBLE * {fs})::BIGINT + ({h}::BIGINT * 60 + {m}::BIGINT) * 60 * {fs})"


def uniform(epoch: str, tag: str, ident: str = "example_id") -> str:
    key = f"md5('7|' || {epoch}::VARCHAR || '|{tag}|' || {ident}::VARCHAR)"
    return f"(('0x' || substr({key}, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def r6(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


# ---- audio -----------------------------------------------------------------------

# frames of 16 samples every 8, mean removed, symmetric Hann window, one-sided density
FRAMES = SIG + """, len AS (SELECT file, count(*) AS n, greatest(0, (count(*) - 8) // 8) AS total FROM sig GROUP BY 1),
  fr AS (SELECT file, n, total, unnest(range(total)) AS frame FROM len),
  raw AS (SELECT fr.file, n, total, frame, pos - frame * 8 AS k, value FROM fr
    JOIN sig ON sig.file = fr.file AND pos >= frame * 8 AND pos < frame * 8 + 16),
  hann AS (SELECT range AS k, 0.5 - 0.5 * cos(2 * pi() * range / 15) AS w FROM range(16)),
  win AS (SELECT file, n, total, frame, k, w * (value - avg(value) OVER (PARTITION BY file, frame)) AS x
    FROM raw JOIN hann USING (k)),
  psd AS (SELECT file, n, total, frame, bin, (pow(sum(x * cos(2 * pi() * bin * k / 16)), 2) + pow(sum(x * sin(2 * pi() * bin * k / 16)), 2))
      / (160 * (SELECT sum(w * w) FROM hann)) * (CASE WHEN bin BETWEEN 1 AND 7 THEN 2 ELSE 1 END) AS v
    FROM win, (SELECT range AS bin FROM range(9)) GROUP BY file, n, total, frame, bin)"""


def pieces(has_tail: str) -> str:
    return f"""WITH {FRAMES},
  kept AS (SELECT * FROM psd WHERE n / 160.0 >= 7 * 0.05::DOUBLE AND total >= 6 AND bin < 5),
  piece AS (
    SELECT file, frame // 6 AS piece_no, frame % 6 AS place, bin, v FROM kept WHERE frame < (total // 6) * 6
    UNION ALL SELECT file, total // 6, frame - total + 6, bin, v FROM kept WHERE {has_tail} AND frame >= total - 6)
  SELECT file, piece_no, 5 AS n_freq, 6 AS n_time, bin * 6 + place AS idx, {r6('v')} AS value FROM piece"""


CLIPS = f"""{SIG}, {SUBS}, iv AS (SELECT episode, line_no AS num, dialogue, {sample('start_tc', 2)} AS s,
  {sample('end_tc', 2)} AS e FROM subs),
  clip AS (SELECT iv.*, pos, value FROM iv LEFT JOIN sig ON sig.file = iv.episode AND pos >= s AND pos < e)"""

# ---- images ----------------------------------------------------------------------

def pixel_query(cte: str, keys: str, source: str, idx: str = "i", value: str = "v") -> str:
    return f"WITH {cte} SELECT {keys}, {idx} AS idx, {r6(f'({value})::DOUBLE')} AS value FROM {source}"


CHANNEL_LAST = PX + """, hwc AS (SELECT example_id, label, ((i % 16) * 4 + i // 16) AS i, v FROM px)"""


def distorted(epoch: str) -> str:
    return f"""draw AS (SELECT example_id, label, {epoch} AS epoch,
      floor({uniform('epoch', 'crop_y')} * 3)::INT AS oy, floor({uniform('epoch', 'crop_x')} * 3)::INT AS ox,
      {uniform('epoch', 'flip')} AS uf, {uniform('epoch', 'brightness')} AS ub, {uniform('epoch', 'contrast')} AS uc,
      pixels FROM ep),
    crop AS (SELECT example_id, epoch, uf, ub, uc, y, x,
      pixels[(oy + y) * 8 + ox + (CASE WHEN uf < 0.5 THEN 5 - x ELSE x END) + 1] + (2 * ub - 1) * 63 AS v
      FROM draw, (SELECT range AS y FROM range(6)), (SELECT range AS x FROM range(6))),
    con AS (SELECT example_id, epoch, y * 6 + x AS i, (v - m) * (0.2 + uc * (1.8 - 0.2)) + m AS v
      FROM (SELECT *, avg(v) OVER (PARTITION BY epoch, example_id) AS m FROM crop)),
    fin AS (SELECT example_id, epoch, i, (v - avg(v) OVER w) / greatest(stddev_pop(v) OVER w, 1.0 / 6) AS v
      FROM con WINDOW w AS (PARTITION BY epoch, example_id))"""


EPOCHS2 = IMG8 + ", ep AS (SELECT *, range::INT AS epoch FROM img8, range(2))"

CONV = PX + """, k AS (SELECT a.range AS ky, b.range AS kx, o.range AS o, (((7 * a.range + 5 * b.range + 3 * o.range) % 11) - 5) / 8.0::DOUBLE AS w
    FROM range(3) a, range(3) b, range(2) o),
  grid AS (SELECT example_id, i // 8 AS y, i % 8 AS x, v FROM px),
  cv AS (SELECT example_id, y - ky + 1 AS y, x - kx + 1 AS x, o, greatest(0, sum(v * w) + 0.125::DOUBLE * o) AS v
    FROM grid, k WHERE y - ky + 1 BETWEEN 0 AND 7 AND x - kx + 1 BETWEEN 0 AND 7 GROUP BY 1, 2, 3, 4),
  pl AS (SELECT example_id, y // 2 AS y, x // 2 AS x, o, max(v) AS v FROM cv GROUP BY 1, 2, 3, 4),
  nrm AS (SELECT example_id, (y * 4 + x) * 2 + o AS i,
    v / pow(1 + 0.5 * sum(v * v) OVER (PARTITION BY example_id, y, x), 0.75) AS v FROM pl)"""

ORACLE: dict[str, str] = {
    # sources
    "read_fixed_records": pixel_query(CHANNEL_LAST, "example_id, label", "hwc"),
    "read_idx": pixel_query(PX, "example_id, label", "px"),
    "explode_batches": f"""WITH {PX} SELECT example_id // 100 AS batch, (row_number() OVER (PARTITION BY example_id // 100, i
      ORDER BY example_id) - 1)::INT AS "offset", label, i AS idx, v AS value FROM px""",
    "read_csv_vectors": pixel_query(PX, "example_id, label", "px"),
    "read_labelled_csv": f"WITH {IMG8} SELECT label, array_to_string(pixels, ',') AS pixels FROM img8",
    "read_tfrecords": pixel_query(PX, "example_id, label", "px"),
    "read_wav_chunks": "SELECT event_id, 160 AS fs, floor(value * 10)::INT AS sample FROM events",
    "read_subtitles": f"""WITH {SUBS} SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY line_no) - 1 AS num,
      dialogue, start_tc, end_tc FROM subs""",
    "label_from_path": """SELECT conv_id, turn, '/audio/' || role || '/' || conv_id || '.wav' AS path,
      list_position(['assistant', 'user'], role) - 1 AS label FROM conversations WHERE role IN ('assistant', 'user')""",
    "label_lookup": """SELECT event_id, event_type, c.label FROM events JOIN
      (VALUES ('view', 0), ('click', 1), ('purchase', 2)) c(event_type, label) USING (event_type)""",
    # sinks
    "write_csv_vectors": f"""WITH {IMG8} SELECT 'images' AS part, example_id || chr(9) || array_to_string(pixels, ',') AS value FROM img8
      UNION ALL SELECT 'labels', example_id || chr(9) || array_to_string(list_transform(range(10), lambda j: CASE WHEN j = label THEN 1 ELSE 0 END), ',')
      FROM img8""",
    "write_labelled_csv": f"""WITH {IMG8} SELECT array_to_string(list_transform(range(10), lambda j: CASE WHEN j = label THEN 1 ELSE 0 END), ',')
      || '|' || array_to_string(pixels, ',') AS value FROM img8""",
    "write_tfrecords": f"WITH {IMG8} SELECT label::BIGINT AS label, array_to_string(pixels, ',') AS pixels FROM img8",
    "write_examples": pixel_query(PX + ", sp AS (SELECT *, CASE WHEN dense_rank() OVER (ORDER BY example_id) <= 120 "
                                  "THEN 'validation' ELSE 'train' END AS split FROM px)", "example_id, label, split", "sp"),
    # parts are cut where the audio is, every 4,096 samples
    "write_clips": f"""WITH {CLIPS} SELECT episode, num, CASE WHEN length(num::VARCHAR) < 4
      THEN lpad(num::VARCHAR, 4, '0') ELSE num::VARCHAR END || ' - ' || replace(dialogue, '\\', '') || '.wav' AS name,
      coalesce(pos // 4096 - s // 4096, 0)::BIGINT AS part_no, (pos - greatest(s, pos // 4096 * 4096))::INT AS pos, {r6('value')} AS sample FROM clip""",
    "write_predictions": f"""WITH {PRED} SELECT '2024-01-01T00:00:00 Label: ' || label || ', Prediction: ' || prediction AS line,
      count(*) AS n FROM lse GROUP BY 1""",
    "checkpoint_weights": f"""WITH {PX} SELECT 2::BIGINT AS step, 'class' || label AS tensor, i AS idx, {r6('avg(v) * 2')} AS value
      FROM px GROUP BY label, i""",
    "write_metrics": f"WITH {LOG} SELECT 'run-1' AS run, step, count(*) AS n, {r6('sum(loss)')} AS total FROM log GROUP BY step",
    "verify_examples": f"""WITH {IMG8} SELECT example_id, (SELECT count(*) FROM img8) AS num_images,
      (SELECT count(label) FROM img8) AS num_labels, label FROM img8 ORDER BY example_id LIMIT 10""",
    # preparation
    "split_record": pixel_query(PX, "example_id, label", "px"),
    "to_channel_last": pixel_query(CHANNEL_LAST, "example_id", "hwc"),
    "flatten_images": pixel_query(PX, "example_id", "px"),
    "rescale_pixels": pixel_query(PX, "example_id", "px", value="v / 255.0::DOUBLE"),
    "one_hot": f"WITH {IMG8} SELECT example_id, range::INT AS idx, CASE WHEN range = label THEN 1.0::DOUBLE ELSE 0 END AS value FROM img8, range(10)",
    "argmax_decode": f"WITH {PRED} SELECT example_id, prediction FROM lse",
    "random_crop": f"""WITH {IMG8}, d AS (SELECT *, floor({uniform('1', 'crop_y')} * 3)::INT AS oy,
      floor({uniform('1', 'crop_x')} * 3)::INT AS ox FROM img8)
      SELECT example_id, y * 6 + x AS idx, pixels[(oy + y) * 8 + ox + x + 1]::DOUBLE AS value
      FROM d, (SELECT range::INT AS y FROM range(6)), (SELECT range::INT AS x FROM range(6))""",
    "random_flip_lr": f"""WITH {PX} SELECT example_id, CASE WHEN {uniform('1', 'flip')} < 0.5 THEN i // 8 * 8 + 7 - i % 8 ELSE i END AS idx,
      v AS value FROM px""",
    "random_brightness": pixel_query(PX, "example_id", "px", value=f"v + (2 * {uniform('1', 'brightness')} - 1) * 63"),
    "random_contrast": f"""WITH {CHANNEL_LAST}, c AS (SELECT *, avg(v) OVER (PARTITION BY example_id, i % 4) AS m FROM hwc)
      SELECT example_id, i AS idx, {r6(f"(v - m) * (0.2 + {uniform('1', 'contrast')} * (1.8 - 0.2)) + m")} AS value FROM c""",
    "standardize_image": pixel_query(STD, "example_id", "std"),
    "center_crop_or_pad": f"""WITH {IMG8} SELECT example_id, y * 11 + x AS idx,
      CASE WHEN x BETWEEN 1 AND 8 THEN pixels[(y + 1) * 8 + x - 1 + 1] ELSE 0 END::DOUBLE AS value
      FROM img8, (SELECT range::INT AS y FROM range(5)), (SELECT range::INT AS x FROM range(11))""",
    "distorted_inputs": pixel_query(EPOCHS2 + ", " + distorted("epoch"), "epoch, example_id", "fin"),
    "eval_inputs": f"""WITH {IMG8}, c AS (SELECT example_id, y * 6 + x AS i, pixels[(y + 1) * 8 + x + 1 + 1]::DOUBLE AS v
      FROM img8, (SELECT range::INT AS y FROM range(6)), (SELECT range::INT AS x FROM range(6)))
      SELECT example_id, i AS idx, {r6('(v - avg(v) OVER w) / greatest(stddev_pop(v) OVER w, 1.0 / 6)')} AS value
      FROM c WINDOW w AS (PARTITION BY example_id)""",
    "timecode_to_sample": f"""WITH {SUBS} SELECT episode, line_no, {sample('start_tc', 44100)} AS start_sample,
      {sample('end_tc', 44100)} AS end_sample FROM subs""",
    "select_channel": "SELECT event_id, user_id % 2 AS channel, value FROM events WHERE user_id % 2 = 0",
    "softmax_probs": f"WITH {PRED} SELECT example_id, j AS idx, {r6('p')} AS value FROM soft",
    "lr_schedule": f"WITH {LOG} SELECT run, step, {r6('0.1::DOUBLE * pow(0.5, step // 350)', 12)} AS learning_rate FROM log",
    "clean_metric_tag": """SELECT event_id, regexp_replace('tower_' || user_id || '/' || event_type || '/tower_/loss',
      'tower_[0-9]*/', '', 'g') AS tag FROM events""",
    "every_n_steps": f"WITH {LOG} SELECT run, step, loss FROM log WHERE step % 10 = 0",
    # pairing, splits, batches
    "zip_by_position": f"""WITH {IMG8}, a AS (SELECT row_number() OVER (ORDER BY example_id) - 1 AS idx, example_id, pixels[1] AS first_pixel FROM img8),
      b AS (SELECT row_number() OVER (ORDER BY label_id) - 1 AS idx, * FROM (SELECT example_id * 3 + 1 AS label_id, label AS paired_label FROM img8))
      SELECT * FROM a JOIN b USING (idx)""",
    "global_index": """SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx,
      count(*) OVER () AS n_rows, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx_in_customer FROM orders""",
    "hash_uniform": f"SELECT event_id, {r6(uniform('2', 'test', 'event_id'), 9)} AS u FROM events",
    "extract_clips": f"""WITH {CLIPS} SELECT episode, num, count(value) AS n, {r6('sum(value)')} AS total,
      min(value) AS lowest, max(value) AS highest FROM clip GROUP BY 1, 2""",
    "union_batches": f"""WITH {PX} SELECT 0 AS batch, example_id, label, i AS idx, v AS value FROM px
      UNION ALL SELECT 1, example_id, 0, i, v FROM px""",
    "split_validation": f"""WITH {IMG8} SELECT example_id, CASE WHEN row_number() OVER (ORDER BY example_id) <= 120
      THEN 'validation' ELSE 'train' END AS split FROM img8""",
    "shuffle_epoch": """SELECT vec_id AS example_id,
      row_number() OVER (ORDER BY md5('7|3|shuffle|' || vec_id::VARCHAR), vec_id) - 1 AS rank FROM embeddings""",
    "assign_batches": """WITH r AS (SELECT vec_id AS example_id, range::INT AS epoch, range * count(*) OVER (PARTITION BY range)
        + row_number() OVER (PARTITION BY range ORDER BY md5('7|' || range || '|shuffle|' || vec_id::VARCHAR), vec_id) - 1 AS p
        FROM embeddings, range(3))
      SELECT example_id, epoch, p // 128 AS step, (p % 128)::INT AS slot FROM r""",
    "assign_batches_partial": """WITH r AS (SELECT vec_id AS example_id, range::INT AS epoch, count(*) OVER (PARTITION BY range) AS n,
        row_number() OVER (PARTITION BY range ORDER BY vec_id) - 1 AS p FROM embeddings, range(2))
      SELECT example_id, epoch, epoch * ((n + 127) // 128) + p // 128 AS step, (p % 128)::INT AS slot FROM r""",
    "bootstrap_batches": f"""WITH {IMG8}, n AS (SELECT count(*) AS n FROM img8),
      d AS (SELECT unnest(range((n + 49) // 50 * 50)) AS id, n FROM n),
      w AS (SELECT id // 50 AS step, (id % 50)::INT AS slot, floor({uniform('0', 'bootstrap', 'id')} * n)::BIGINT AS idx FROM d),
      x AS (SELECT example_id, label, row_number() OVER (ORDER BY example_id) - 1 AS idx FROM img8)
      SELECT step, slot, example_id, label FROM w JOIN x USING (idx)""",
    "repeat_epochs": f"WITH {IMG8} SELECT example_id, range::INT AS epoch, label FROM img8, range(3)",
    "preview": f"WITH {IMG8} SELECT example_id, label FROM img8 ORDER BY example_id LIMIT 10",
    # audio
    "filter_short_audio": f"WITH {SIG} SELECT file, count(*) AS n_frames FROM sig GROUP BY 1 HAVING count(*) / 160.0 >= 7 * 0.05::DOUBLE",
    "count_short_audio": f"""WITH {SIG} SELECT count(*) AS dropped FROM
      (SELECT file FROM sig GROUP BY 1 HAVING count(*) / 160.0 < 7 * 0.05::DOUBLE)""",
    "spectrogram": f"WITH {FRAMES} SELECT file, frame, bin AS idx, {r6('v')} AS value FROM psd",
    "crop_frequencies": f"WITH {FRAMES} SELECT file, frame, bin AS idx, {r6('v')} AS value FROM psd WHERE bin < 5",
    "spectrogram_pieces": pieces("(total // 6) * 6 < total"),
    "spectrogram_pieces_reference_tail": pieces("(total // 6) * (total // 6) < total"),
    # aggregates
    "accuracy": f"""WITH {PRED} SELECT example_id // 100 AS step, {r6('avg(CASE WHEN prediction = label THEN 1.0 ELSE 0 END)')} AS accuracy
      FROM lse GROUP BY 1""",
    "cross_entropy": f"WITH {PRED} SELECT {r6('avg(lse - zy)')} AS sparse, {r6('avg(lse - zy)')} AS onehot FROM lse",
    "total_loss": f"""WITH {PRED} SELECT {r6(f"avg(lse - zy) + (SELECT 0.004 * 0.5 * sum(pow({WEIGHT}, 2)) FROM (SELECT range AS i FROM range(64)), cls)")}
      AS total_loss FROM lse""",
    "tensor_summary": f"""WITH {STD} SELECT label, {r6('avg(v)')} AS mean, {r6('stddev_pop(v)')} AS stddev, {r6('min(v)')} AS min,
      {r6('max(v)')} AS max FROM std GROUP BY 1""",
    "histogram": f"""WITH {LOG}, b AS (SELECT run, min(loss) AS lo, max(loss) AS hi FROM log GROUP BY 1),
      c AS (SELECT run, lo, hi, CASE WHEN hi > lo THEN least(floor((loss - lo) / (hi - lo) * 30), 29) ELSE 0 END::INT AS bucket
        FROM log JOIN b USING (run))
      SELECT run, bucket, {r6('lo + bucket * ((hi - lo) / 30)')} AS lower, {r6('lo + (bucket + 1) * ((hi - lo) / 30)')} AS upper,
        count(*) AS n FROM c GROUP BY run, lo, hi, bucket""",
    "sparsity": f"WITH {STD} SELECT label, {r6('avg(CASE WHEN v <= 0 THEN 1.0::DOUBLE ELSE 0 END)', 12)} AS sparsity FROM std GROUP BY 1",
    "activation_summary": f"""WITH {CONV}, {CLASSES}, a AS (
        SELECT 'conv0' AS tag, v FROM cv UNION ALL SELECT 'pool1', v FROM pl UNION ALL SELECT 'lrn2', v FROM nrm
        UNION ALL SELECT 'dense3', sum(v * ({WEIGHT})) FROM nrm, cls GROUP BY example_id, j)
      SELECT tag, {r6('avg(v)')} AS mean, {r6('stddev_pop(v)')} AS stddev, {r6('min(v)')} AS min, {r6('max(v)')} AS max,
        {r6('avg(CASE WHEN v = 0 THEN 1.0::DOUBLE ELSE 0 END)', 12)} AS sparsity FROM a GROUP BY tag""",
    "validate_examples": f"""WITH {IMG8} SELECT count(*) AS num_rows, count(pixels) AS num_images, count(label) AS num_labels,
      min(len(pixels)) AS min_size, max(len(pixels)) AS max_size, count(*) FILTER (len(pixels) <> 64) AS bad_shape,
      0 AS not_depth_1 FROM img8""",
    "nan_guard": "SELECT count(*) FILTER (isnan(CASE WHEN value > 100 THEN 'NaN'::DOUBLE ELSE value END)) AS nan_count FROM events",
    "evaluate_model": f"""WITH {PRED} SELECT {r6('avg(CASE WHEN prediction = label THEN 1.0 ELSE 0 END)')} AS accuracy,
      {r6('avg(lse - zy)')} AS loss, count(*) AS n, 1000 AS global_step FROM lse""",
    # series
    "ema_losses": f"""WITH {LOG} SELECT a.run, a.step, any_value(a.loss) AS loss,
      {r6('sum(0.1 * pow(0.9, a.step - b.step) * b.loss) / (1 - pow(0.9, a.step + 1))')} AS ema
      FROM log a JOIN log b ON a.run = b.run AND b.step <= a.step GROUP BY a.run, a.step""",
    "ema_variables": f"""WITH {LOG}, d AS (SELECT *, least(0.9999::DOUBLE, (1 + step)::DOUBLE / (10 + step)) AS d FROM log),
      p AS (SELECT *, exp(sum(ln(d)) OVER (PARTITION BY run ORDER BY step)) AS p,
        CASE WHEN step = 0 THEN loss ELSE (1 - d) * loss END AS b FROM d)
      SELECT run, step, {r6('p * sum(b / p) OVER (PARTITION BY run ORDER BY step)')} AS ema FROM p""",
    "throughput": f"""WITH {LOG}, t AS (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run ORDER BY step)) / 1e6::DOUBLE AS s FROM log)
      SELECT run, step, {r6('s')} AS sec_per_batch, CASE WHEN s > 0 THEN {r6('128 / s')} END AS examples_per_sec FROM t""",
    "log_lines": f"""WITH {LOG}, t AS (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run ORDER BY step)) / 1e6::DOUBLE AS s FROM log)
      SELECT run, step, printf('%s: step %d, loss = %s (%s examples/sec; %s sec/batch)', ts::VARCHAR, step,
        round(loss::DECIMAL(20, 6), 2)::DECIMAL(20, 2)::VARCHAR,
        CASE WHEN s > 0 THEN round((128 / s)::DECIMAL(30, 12), 1)::DECIMAL(20, 1)::VARCHAR ELSE 'NaN' END,
        coalesce(round(s::DECIMAL(30, 12), 3)::DECIMAL(20, 3)::VARCHAR, 'NaN')) AS line FROM t WHERE step % 10 = 0""",
    # learning
    "score_dense": f"WITH {PRED} SELECT example_id, j AS idx, {r6('z')} AS value FROM logit",
    "score_cnn": f"""WITH {CONV}, {CLASSES} SELECT example_id, j AS idx, {r6(f'sum(v * ({WEIGHT}))')} AS value
      FROM nrm, cls GROUP BY example_id, j""",
    "predict_batches": f"""WITH {PRED} SELECT l.example_id, l.label, prediction, {r6('max(p)')} AS probability
      FROM lse l JOIN soft USING (example_id) GROUP BY 1, 2, 3""",
    "train_softmax_step": f"""WITH {PX}, x AS (SELECT example_id, label, i, v / 255.0::DOUBLE AS v FROM px
        UNION ALL SELECT example_id, label, 64, 1.0::DOUBLE FROM img8), {CLASSES},
      w AS (SELECT i, j, CASE WHEN i = 64 THEN j / 1000.0::DOUBLE ELSE {WEIGHT} END AS w FROM (SELECT range AS i FROM range(65)), cls),
      z AS (SELECT example_id, any_value(label) AS label, j, sum(v * w) AS z FROM x JOIN w USING (i) GROUP BY example_id, j),
      e AS (SELECT example_id, j, exp(z - max(z) OVER q) / sum(exp(z - m)) OVER q - CASE WHEN j = label THEN 1 ELSE 0 END AS d
        FROM (SELECT *, max(z) OVER (PARTITION BY example_id) AS m FROM z) WINDOW q AS (PARTITION BY example_id)),
      g AS (SELECT i, j, sum(v * d) / (SELECT count(*) FROM img8) AS g FROM x JOIN e USING (example_id) GROUP BY i, j)
      SELECT CASE WHEN i = 64 THEN 'b0' ELSE 'w0' END AS tensor, CASE WHEN i = 64 THEN 0 ELSE i END AS row, j AS col,
        {r6('g')} AS gradient, {r6('w - 0.5 * g')} AS value FROM g JOIN w USING (i, j)""",
}
ORACLE["stream_score"] = ORACLE["predict_batches"]
ORACLE["stream_score_tfrecords"] = ORACLE["predict_batches"]
ORACLE["read_tfrecord_ranges"] = ORACLE["read_tfrecords"]
ORACLE["exponent_histogram"] = """WITH b AS (
    SELECT event_type, CASE WHEN value = 0 THEN 0 ELSE sign(value) * (floor(log2(abs(value))) + 1076) END::INTEGER AS bucket FROM events WHERE value IS NOT NULL)
  SELECT event_type, bucket, CASE WHEN bucket < 0 THEN -pow(2, -bucket - 1075) WHEN bucket = 0 THEN 0 ELSE pow(2, bucket - 1076) END::DOUBLE AS lower,
    CASE WHEN bucket < 0 THEN -pow(2, -bucket - 1076) WHEN bucket = 0 THEN 0 ELSE pow(2, bucket - 1075) END::DOUBLE AS upper, count(*)::BIGINT AS n
  FROM b GROUP BY event_type, bucket"""
ORACLE["training_events"] = """SELECT (('0x' || substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT % 4)::INTEGER AS shard, count(*)::BIGINT AS n_rows,
    ceil(count(*) / 50.0)::BIGINT AS steps, 0::BIGINT AS untimed FROM embeddings GROUP BY 1"""


def descent(steps: int, chosen: str, lr: float = 0.5) -> str:
    """Weights of the softmax classifier after gradient steps from zero, step k over the rows that `chosen` allows for it."""
    ctes = [PX, """x AS (SELECT example_id, label, i, v / 255.0::DOUBLE AS v FROM px
        UNION ALL SELECT example_id, label, 64, 1.0::DOUBLE FROM img8)""", CLASSES,
            "w0 AS (SELECT i, j, 0.0::DOUBLE AS w FROM (SELECT range AS i FROM range(65)), cls)"]
    for k in range(steps):
        ctes.append(f"""x{k} AS (SELECT * FROM x WHERE {chosen.format(k=k)}),
      z{k} AS (SELECT example_id, any_value(label) AS label, j, sum(v * w) AS z FROM x{k} JOIN w{k} USING (i) GROUP BY example_id, j),
      e{k} AS (SELECT example_id, j, exp(z - m) / sum(exp(z - m)) OVER (PARTITION BY example_id) - CASE WHEN j = label THEN 1 ELSE 0 END AS d
        FROM (SELECT *, max(z) OVER (PARTITION BY example_id) AS m FROM z{k})),
      g{k} AS (SELECT i, j, sum(v * d) / count(DISTINCT example_id) AS g FROM x{k} JOIN e{k} USING (example_id) GROUP BY i, j),
      w{k + 1} AS (SELECT i, j, w - {lr} * coalesce(g, 0) AS w FROM w{k} LEFT JOIN g{k} USING (i, j))""")
    return f"""WITH {', '.join(ctes)} SELECT CASE WHEN i = 64 THEN 'b0' ELSE 'w0' END AS tensor, CASE WHEN i = 64 THEN 0 ELSE i END::INT AS row,
      j AS col, {r6('w')} AS value FROM w{steps}"""


ORACLE["train_parallel"] = descent(3, "true")
ORACLE["stream_train"] = descent(4, "example_id % 4 = {k}")
