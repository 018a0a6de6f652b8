"""DuckDB SQL for the registered queries, written from the semantics rather than from the plans."""

from __future__ import annotations

from .queries import FRAME, LOUD
from .views import FOLDERS, HOUR, TWINS

H = f"{HOUR}::DOUBLE"

TALK = """seg AS (
  SELECT conv_id::VARCHAR AS call_id, turn::INT AS seg_idx, role AS speaker, text, turn % 3 = 2 AS overlap,
         (sum(20 * length(text)) OVER w - 20 * length(text))::DOUBLE / 1000 AS "start", (sum(20 * length(text)) OVER w)::DOUBLE / 1000 AS "end"
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))"""

EVENTS = """seg AS (
  SELECT user_id::VARCHAR AS call_id, event_id::INT AS seg_idx, event_type AS speaker, event_type AS text, event_id % 4 = 1 AS overlap,
         epoch_us(ts)::DOUBLE AS "start", epoch_us(ts)::DOUBLE + round(value * 1000000::DOUBLE) AS "end"
  FROM events)"""

REGIONS = f"""reg AS (
  SELECT call_id, speaker, row_number() OVER (PARTITION BY call_id, speaker ORDER BY "start", seg_idx) - 1 AS r_idx,
         "start" + CASE WHEN "end" - "start" < 20000000 THEN {H} / 4 ELSE 0 END AS s, "end" + {H} / 2 AS e
  FROM seg)"""

CLUSTERS = f"""marked AS (
  SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY call_id, speaker ORDER BY r_idx) >= 5 * {H} THEN 1 ELSE 0 END AS opens FROM reg),
numbered AS (SELECT *, (sum(opens) OVER (PARTITION BY call_id, speaker ORDER BY r_idx))::INT AS c_idx FROM marked),
clu AS (SELECT call_id, speaker, c_idx, arg_min(s, r_idx) AS s, arg_max(e, r_idx) AS e, count(*) AS n_regions FROM numbered GROUP BY ALL)"""


def fold(longest: str, gap: str, target: str) -> str:
    """Greedy groups by following each speaker's turns one by one."""
    opens = f'(t."end" - r.g0 > {longest} OR t."start" - r.last > {gap} OR r.last - r.g0 >= {target})'
    return f"""t AS (SELECT *, row_number() OVER (PARTITION BY call_id, speaker ORDER BY "start", seg_idx) AS rn FROM seg WHERE text <> '' AND speaker <> ''),
r AS (
  SELECT call_id, speaker, rn, seg_idx, "start" AS g0, "end" AS last, 0 AS group_idx FROM t WHERE rn = 1
  UNION ALL
  SELECT t.call_id, t.speaker, t.rn, t.seg_idx, CASE WHEN {opens} THEN t."start" ELSE r.g0 END, t."end", r.group_idx + {opens}::INT
  FROM r JOIN t ON t.call_id = r.call_id AND t.speaker = r.speaker AND t.rn = r.rn + 1)"""


TALK_FOLD = fold("60::DOUBLE", "10::DOUBLE", "30::DOUBLE")
EVENT_FOLD = fold(f"36 * {H}", f"6 * {H}", f"18 * {H}")

TALK_CHUNKS = f"""{TALK}, {TALK_FOLD},
mem AS (SELECT r.group_idx, seg.* FROM r JOIN seg USING (call_id, speaker, seg_idx)),
chunk AS (
  SELECT call_id, speaker, group_idx, min("start") AS "start", arg_max("end", ("start", seg_idx)) AS "end",
         trim(string_agg(text, ' ' ORDER BY "start", seg_idx)) AS text, bool_or(overlap) AS has_overlap, count(*) AS n,
         sum(CASE WHEN overlap THEN greatest(0, "end" - "start") ELSE 0 END) AS crossed
  FROM mem GROUP BY ALL),
talk AS (SELECT *, CASE WHEN "end" > "start" THEN least(1, crossed / ("end" - "start")) ELSE 0 END AS overlap_fraction FROM chunk)"""

WORDS = r"""raw AS (SELECT doc_id::VARCHAR AS call_id, list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda w: w <> '') AS ws FROM documents),
flat AS (SELECT call_id, unnest(ws) AS text, generate_subscripts(ws, 1) - 1 AS word_idx FROM raw),
timed AS (SELECT *, sum(60 * length(text) + (word_idx * 37) % 11 * 80) OVER (PARTITION BY call_id ORDER BY word_idx ROWS UNBOUNDED PRECEDING) AS upto FROM flat),
words AS (SELECT call_id, 'reader' AS speaker, word_idx, text, (upto - 60 * length(text))::DOUBLE AS "start", upto::DOUBLE AS "end", ((word_idx * 7) % 10)::DOUBLE / 10 AS score FROM timed)"""

SIGNALS = f"""sig AS (SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE * 32767)::BIGINT) AS x FROM embeddings),
samples AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS i, len(x) // {FRAME} AS total FROM sig),
frames AS (SELECT vec_id, label, (i // {FRAME})::INT AS frame_idx, sum(v * v)::BIGINT AS energy FROM samples WHERE i < total * {FRAME} GROUP BY ALL)"""

SPEECH = f"""{SIGNALS},
loud AS (SELECT vec_id, frame_idx, frame_idx - row_number() OVER (PARTITION BY vec_id ORDER BY frame_idx) AS island FROM frames WHERE energy > {LOUD}),
run AS (SELECT vec_id, min(frame_idx) AS s, max(frame_idx) + 1 AS e FROM loud GROUP BY vec_id, island),
region AS (SELECT vec_id, (row_number() OVER (PARTITION BY vec_id ORDER BY s) - 1)::INT AS r_idx, s, e FROM run),
tot AS (SELECT vec_id, len(x) // {FRAME} AS total FROM sig)"""

MEASURED = f"""m AS (
  SELECT doc_id, text, n_chars, 0::DOUBLE AS "start", (n_chars % 400)::DOUBLE / 10 AS "end",
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (n_chars % 390)::DOUBLE / 10 END AS clip_duration,
         CASE WHEN doc_id % 7 <> 0 THEN (doc_id % 10)::DOUBLE / 10 END AS silence_ratio,
         CASE WHEN doc_id % 11 <> 0 THEN (n_chars % 350)::DOUBLE / 10 END AS chars_per_sec,
         (doc_id % 9)::DOUBLE / 8 AS overlap_fraction, doc_id % 4 = 0 AS has_overlap,
         CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS audio_quality, quality::DOUBLE AS alignment_score, CASE WHEN doc_id % 3 <> 0 THEN 1 - toxic::DOUBLE / 2 END AS agreement_score
  FROM (SELECT doc_id, text, n_chars FROM documents UNION ALL SELECT doc_id + {TWINS}, 'x', n_chars FROM documents WHERE doc_id % 53 = 0) LEFT JOIN labels USING (doc_id)),
measured AS (SELECT *, coalesce(clip_duration, greatest(0, "end" - "start")) AS duration FROM m)"""


def script(low: str, high: str, text: str = "text") -> str:
    letters = f"regexp_replace({text}, '[^\\p{{L}}]', '', 'g')"
    ours = f"length(regexp_replace({letters}, '[^\\x{{{low}}}-\\x{{{high}}}]', '', 'g'))"
    digits = f"length(regexp_replace({text}, '[^\\p{{Nd}}]', '', 'g'))"
    return f"coalesce(({ours} + {digits})::DOUBLE / nullif(length({letters}) + {digits}, 0), 0)"


JUDGED = f"""{MEASURED},
judged AS (
  SELECT *, CASE WHEN length(text) < 2 THEN 'too_short_text' WHEN duration < 1 THEN 'under_min_duration' WHEN duration > 28 THEN 'over_max_duration'
    WHEN audio_quality <> '' AND audio_quality <> 'good' THEN 'audio_quality:' || audio_quality WHEN silence_ratio > 0.6::DOUBLE THEN 'too_silent'
    WHEN chars_per_sec < 3 THEN 'cps_too_low' WHEN chars_per_sec > 28 THEN 'cps_too_high' WHEN {script("0061", "024F")} < 0.55::DOUBLE THEN 'not_persian'
    WHEN overlap_fraction > 0.6::DOUBLE THEN 'excess_overlap' END AS reject_reason
  FROM measured)"""


def confidence(align: str, agree: str, overlap: str, cps: str) -> str:
    c = lambda x: f"greatest(0::DOUBLE, least(1::DOUBLE, {x}))"
    total = f"(coalesce(0.5::DOUBLE * {c(align)} * ({align} - {align} + 1), 0) + coalesce(0.5::DOUBLE * {c(agree)} * ({agree} - {agree} + 1), 0))"
    weight = f"((CASE WHEN {align} IS NULL THEN 0 ELSE 0.5::DOUBLE END) + (CASE WHEN {agree} IS NULL THEN 0 ELSE 0.5::DOUBLE END))"
    pen = f"(CASE WHEN {overlap} <> 0 THEN greatest(0.4::DOUBLE, 1 - {overlap}) ELSE 1 END) * (CASE WHEN {cps} < 3 OR {cps} > 28 THEN 0.6::DOUBLE ELSE 1 END)"
    return c(f"coalesce({total} / nullif({weight}, 0), 0.5::DOUBLE) * {pen}")


def tier(c: str) -> str:
    return f"CASE WHEN coalesce({c}, 0) >= 0.85::DOUBLE THEN 'accept' WHEN coalesce({c}, 0) >= 0.6::DOUBLE THEN 'downweight' ELSE 'review' END"


SCORED = f"""{MEASURED},
conf AS (SELECT *, {confidence("alignment_score", "agreement_score", "overlap_fraction", "chars_per_sec")} AS confidence FROM measured),
scored AS (SELECT *, {tier("confidence")} AS tier, CASE {tier("confidence")} WHEN 'accept' THEN 1::DOUBLE WHEN 'downweight' THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS loss_weight FROM conf)"""

CAPPED = f"""{SCORED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY has_overlap ORDER BY coalesce(confidence, 0) DESC, doc_id) AS place,
         count(*) OVER () AS total FROM scored),
capped AS (SELECT * FROM ranked WHERE NOT has_overlap OR place <= trunc(0.12::DOUBLE * total))"""

GOLD = f"""{SCORED},
mixed AS (
  SELECT doc_id AS id, text, tier, loss_weight, NULL AS source FROM scored
  UNION ALL
  SELECT item_id, text, 'gold', CASE WHEN item_id % 3 = 0 THEN 2::DOUBLE ELSE 1::DOUBLE END, 'gold' FROM benchmark, generate_series(1, 3))"""

MANIFEST = r"""man AS (
  SELECT row_number() OVER () AS row_id, CASE WHEN role = 'system' THEN ' Silence ' ELSE role END AS speaker,
         CASE WHEN (conv_id + turn) % 9 = 0 THEN ' ' || chr(9) ELSE text END AS text,
         CASE WHEN turn % 4 = 3 THEN NULL ELSE 'clips/' || conv_id || '.wav' END AS audio_path, CASE WHEN turn > 0 THEN turn::DOUBLE / 8 END AS confidence
  FROM conversations),
there AS (
  SELECT DISTINCT root || 'clips/' || conv_id || '.wav' AS path FROM conversations, (VALUES ('', 5), ('/work/', 3), ('/data/build/', 2)) v(root, n) WHERE conv_id % n = 0),
resolved AS (
  SELECT man.*, CASE WHEN audio_path IN (SELECT path FROM there) THEN audio_path
    WHEN '/work/' || audio_path IN (SELECT path FROM there) THEN '/work/' || audio_path
    WHEN '/data/build/' || audio_path IN (SELECT path FROM there) THEN '/data/build/' || audio_path END AS resolved FROM man),
outcome AS (
  SELECT *, CASE WHEN lower(trim(speaker)) = 'silence' THEN 'dropped_silence' WHEN regexp_replace(text, '^\s+|\s+$', '', 'g') = '' THEN 'missing_text'
    WHEN resolved IS NULL THEN 'missing_audio' ELSE 'kept' END AS outcome FROM resolved)"""

BLANK = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"

TEST_CALLS = "calls AS (SELECT call_id, row_number() OVER (ORDER BY md5(call_id || ':1337'), call_id) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT call_id FROM {src})), test AS (SELECT call_id FROM calls WHERE place <= greatest(1, trunc(n * 0.05::DOUBLE)))"

_SAME = {
    "q00_outcomes": f"""WITH RECURSIVE {TALK_CHUNKS},
c AS (SELECT *, "end" - "start" AS d, length(replace(text, ' ', ''))::DOUBLE / nullif("end" - "start", 0) AS cps,
  CASE WHEN n > 1 THEN 0.9::DOUBLE END AS al, CASE WHEN call_id::BIGINT % 2 = 0 THEN 0.8::DOUBLE END AS ag FROM talk),
j AS (SELECT *, CASE WHEN length(text) < 2 THEN 'too_short_text' WHEN d < 1 THEN 'under_min_duration' WHEN d > 60 THEN 'over_max_duration' WHEN cps < 3 THEN 'cps_too_low'
  WHEN cps > 28 THEN 'cps_too_high' WHEN {script("0061", "024F")} < 0.55::DOUBLE THEN 'not_persian' WHEN overlap_fraction > 0.6::DOUBLE THEN 'excess_overlap' END AS reject_reason FROM c),
k AS (SELECT *, CASE WHEN reject_reason IS NULL THEN {tier(confidence("al", "ag", "overlap_fraction", "cps"))} END AS tier FROM j)
SELECT reject_reason, tier, count(*) AS n_chunks, round(sum(d), 3) AS seconds FROM k GROUP BY ALL""",
    "q01_segments_from_turns": f"""WITH {TALK} SELECT *, greatest(0, "end" - "start") AS duration FROM seg WHERE text <> '' AND speaker <> ''""",
    "q02_turns_by_speaker": f"""WITH {TALK} SELECT call_id, speaker, count(*) AS n_turns, string_agg(seg_idx::VARCHAR, ',' ORDER BY "start", seg_idx) AS seg_ids FROM seg WHERE text <> '' AND speaker <> '' GROUP BY ALL""",
    "q03_group_turns": f"WITH RECURSIVE {TALK}, {TALK_FOLD} SELECT call_id, speaker, group_idx, seg_idx FROM r",
    "q04_group_events": f"WITH RECURSIVE {EVENTS}, {EVENT_FOLD} SELECT call_id, speaker, group_idx, seg_idx FROM r",
    "q04_group_events_scan": f"WITH RECURSIVE {EVENTS}, {EVENT_FOLD} SELECT call_id, speaker, group_idx, seg_idx FROM r",
    "q05_gap_groups": f"""WITH {EVENTS}, g AS (SELECT *, CASE WHEN "start" - lag("end") OVER w > 6 * {H} THEN 1 ELSE 0 END AS opens FROM seg WINDOW w AS (PARTITION BY call_id, speaker ORDER BY "start", seg_idx))
SELECT call_id, speaker, (sum(opens) OVER (PARTITION BY call_id, speaker ORDER BY "start", seg_idx))::INT AS group_idx, seg_idx FROM g""",
    "q06_silence_clusters": f"WITH {EVENTS}, {REGIONS}, {CLUSTERS} SELECT * FROM clu",
    "q07_regions_clipped": f"""WITH {EVENTS}, {REGIONS}, win AS (SELECT call_id, speaker, min("start") AS g0, min("start") + 240 * {H} AS g1 FROM seg GROUP BY ALL)
SELECT call_id, speaker, greatest(s, g0) AS s, least(e, g1) AS e FROM reg JOIN win USING (call_id, speaker) WHERE least(e, g1) > greatest(s, g0)""",
    "q08_best_cluster": f"""WITH {EVENTS}, {REGIONS}, {CLUSTERS},
wide AS (SELECT call_id, speaker, seg_idx, "start" - 3 * {H} AS a, "end" + 9 * {H} AS b FROM seg),
met AS (SELECT call_id, speaker, seg_idx, c_idx, least(b, e) - greatest(a, s) AS shared FROM wide JOIN clu USING (call_id, speaker) WHERE s < b AND e > a)
SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY call_id, speaker, seg_idx ORDER BY shared DESC, c_idx) = 1""",
    "q09_split_group": f"""WITH RECURSIVE {EVENTS}, {REGIONS}, {EVENT_FOLD},
mem AS (SELECT r.group_idx, seg.* FROM r JOIN seg USING (call_id, speaker, seg_idx)),
grp AS (SELECT call_id, speaker, group_idx, min("start") AS g0, arg_max("end", ("start", seg_idx)) AS g1 FROM mem GROUP BY ALL),
inwin AS (SELECT call_id, speaker, group_idx, r_idx, greatest(s, g0) AS s, least(e, g1) AS e FROM grp JOIN reg USING (call_id, speaker) WHERE least(e, g1) > greatest(s, g0)),
mark AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY call_id, speaker, group_idx ORDER BY r_idx) >= 5 * {H} THEN 1 ELSE 0 END AS opens FROM inwin),
num AS (SELECT *, sum(opens) OVER (PARTITION BY call_id, speaker, group_idx ORDER BY r_idx) AS c FROM mark),
clu AS (SELECT call_id, speaker, group_idx, c, arg_min(s, r_idx) AS s, arg_max(e, r_idx) AS e FROM num GROUP BY ALL),
cnt AS (SELECT call_id, speaker, group_idx, count(*) AS k FROM clu GROUP BY ALL),
put AS (SELECT mem.*, c, s, e, greatest(0, least("end", e) - greatest("start", s)) AS ov FROM mem JOIN clu USING (call_id, speaker, group_idx)),
best AS (SELECT * FROM put WHERE ov > 0 QUALIFY row_number() OVER (PARTITION BY call_id, speaker, group_idx, seg_idx ORDER BY ov DESC, c) = 1),
cut AS (
  SELECT call_id, speaker, group_idx, c, s AS "start", e AS "end", string_agg(seg_idx::VARCHAR, ',' ORDER BY "start", seg_idx) AS seg_ids, bool_or(overlap) AS has_overlap
  FROM best JOIN cnt USING (call_id, speaker, group_idx) WHERE k > 1 GROUP BY ALL),
whole AS (
  SELECT call_id, speaker, group_idx, string_agg(seg_idx::VARCHAR, ',' ORDER BY "start", seg_idx) AS seg_ids, bool_or(overlap) AS has_overlap FROM mem GROUP BY ALL)
SELECT call_id, speaker, group_idx, (row_number() OVER (PARTITION BY call_id, speaker, group_idx ORDER BY c) - 1)::INT AS piece_idx, "start", "end", seg_ids, has_overlap FROM cut
UNION ALL
SELECT call_id, speaker, group_idx, 0, coalesce(clu.s, g0), coalesce(clu.e, g1), seg_ids, has_overlap
FROM whole JOIN grp USING (call_id, speaker, group_idx) LEFT JOIN cnt USING (call_id, speaker, group_idx)
LEFT JOIN clu ON cnt.k = 1 AND clu.call_id = whole.call_id AND clu.speaker = whole.speaker AND clu.group_idx = whole.group_idx
WHERE coalesce(k, 0) <= 1 OR NOT EXISTS (FROM cut WHERE cut.call_id = whole.call_id AND cut.speaker = whole.speaker AND cut.group_idx = whole.group_idx)""",
    "q10_chunk_words": f"""WITH RECURSIVE {WORDS},
n AS (SELECT *, lag("end") OVER (PARTITION BY call_id ORDER BY word_idx) AS before, max(word_idx) OVER (PARTITION BY call_id) + 1 AS total FROM words),
span AS (
  SELECT a.call_id, a.word_idx AS i, coalesce(min(b.word_idx) FILTER (b."end" - a."start" > 28000), any_value(a.total)) AS full_at
  FROM n a LEFT JOIN n b ON b.call_id = a.call_id AND b.word_idx > a.word_idx AND b.word_idx <= a.word_idx + 500 GROUP BY ALL),
jump AS (
  SELECT s.call_id, s.i, coalesce(arg_max(b.word_idx, (b."start" - b.before, -b.word_idx)), any_value(s.full_at)) AS nxt
  FROM span s JOIN n a ON a.call_id = s.call_id AND a.word_idx = s.i
  LEFT JOIN n b ON b.call_id = s.call_id AND b.word_idx > s.i AND b.word_idx < s.full_at AND b.before - a."start" >= 12000 AND b."start" - b.before >= 400 GROUP BY ALL),
walk AS (
  SELECT call_id, i, nxt, 0 AS chunk_idx FROM jump WHERE i = 0
  UNION ALL SELECT j.call_id, j.i, j.nxt, w.chunk_idx + 1 FROM walk w JOIN jump j ON j.call_id = w.call_id AND j.i = w.nxt)
SELECT w.call_id, 'reader' AS speaker, chunk_idx, min("start") AS "start", max("end") AS "end", count(*) AS n_words, md5(string_agg(text, ' ' ORDER BY word_idx)) AS text_md5, round(avg(score), 6) AS confidence
FROM walk w JOIN words ON words.call_id = w.call_id AND word_idx >= i AND word_idx < nxt GROUP BY ALL""",
    "q11_overlap_fraction": f"WITH RECURSIVE {TALK_CHUNKS} SELECT call_id, speaker, group_idx, has_overlap, round(overlap_fraction, 6) AS overlap_fraction, md5(text) AS text_md5 FROM talk",
    "q12_cps": f"WITH {MEASURED} SELECT doc_id, duration, round(length(replace(text, ' ', ''))::DOUBLE / nullif(duration, 0), 6) AS cps FROM measured",
    "q13_frames_vad": f"WITH {SPEECH} SELECT vec_id, r_idx, s, e FROM region",
    "q14_silence_ratio": f"WITH {SPEECH} SELECT vec_id, coalesce(greatest(0::DOUBLE, 1 - coalesce(sum(e - s), 0)::DOUBLE / nullif(any_value(total), 0)), 1) AS silence_ratio FROM tot LEFT JOIN region USING (vec_id) GROUP BY vec_id",
    "q15_silence_gaps": f"""WITH {SPEECH},
gap AS (
  SELECT vec_id, coalesce(lag(e) OVER (PARTITION BY vec_id ORDER BY s), 0) AS gap_start, s AS gap_end FROM region
  UNION ALL SELECT vec_id, coalesce(max(e), 0), any_value(total) FROM tot LEFT JOIN region USING (vec_id) GROUP BY vec_id)
SELECT vec_id, gap_start::INT AS gap_start, gap_end::BIGINT AS gap_end FROM gap WHERE gap_end - gap_start >= 2""",
    "q16_rms_db": "SELECT vec_id, round(20 * log10(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding) + 1e-12) + 1e-12), 6) AS level_db FROM embeddings",
    "q17_channel_corr": """WITH v AS (SELECT vec_id // 2 AS pair, vec_id % 2 AS side, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT a.pair, round(corr(a.x, b.x), 6) AS correlation FROM v a JOIN v b ON a.pair = b.pair AND a.i = b.i AND a.side = 0 AND b.side = 1 GROUP BY a.pair""",
    "q18_energy_share": f"""WITH {SIGNALS}, e AS (SELECT label, vec_id % 4 AS channel, sum(energy)::BIGINT AS energy FROM frames GROUP BY ALL)
SELECT *, round(energy / (sum(energy) OVER (PARTITION BY label) + 1e-12), 9) AS share FROM e""",
    "q19_channel_assign": f"""WITH {SIGNALS},
e AS (SELECT (vec_id // 4)::VARCHAR AS call_id, CASE WHEN vec_id % 4 < 2 THEN 'agent' ELSE 'caller' END AS speaker, (vec_id % 2)::INT AS channel, sum(energy) AS energy FROM frames GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY energy DESC, speaker, channel) AS place FROM e),
first AS (SELECT call_id, speaker, channel FROM top WHERE place = 1)
SELECT * FROM first UNION ALL
SELECT DISTINCT e.call_id, e.speaker, 1 - first.channel FROM e JOIN first ON e.call_id = first.call_id AND e.speaker <> first.speaker""",
    "q19_turns_with_channel": f"""WITH {TALK}, {SIGNALS},
e AS (SELECT (vec_id // 4)::VARCHAR AS call_id, CASE WHEN vec_id % 4 < 2 THEN 'assistant' ELSE 'user' END AS speaker, (vec_id % 2)::INT AS channel, sum(energy) AS energy FROM frames GROUP BY ALL),
first AS (SELECT call_id, speaker, channel FROM e QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY energy DESC, speaker, channel) = 1),
map AS (SELECT * FROM first UNION ALL SELECT DISTINCT e.call_id, e.speaker, 1 - first.channel FROM e JOIN first ON e.call_id = first.call_id AND e.speaker <> first.speaker)
SELECT call_id, speaker, seg_idx, coalesce(channel, 0) AS channel FROM seg LEFT JOIN map USING (call_id, speaker)""",
    "q20_normalize": rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(text, 'يىكة' || chr(8204) || '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', 'ییکه 01234567890123456789'), '[\x{{064b}}-\x{{0652}}\x{{0670}}]', '', 'g'),
  '[^\p{{L}}\p{{N}}_\x{{0600}}-\x{{06FF}}\s]', ' ', 'g'), '{BLANK}+', ' ', 'g'), '^ | $', '', 'g') AS normalized FROM documents""",
    "q21_script_ratio": f"SELECT doc_id, round({script('00C0', '024F')}, 9) AS ratio FROM documents",
    "q22_reject_reason": f"WITH {JUDGED} SELECT doc_id, reject_reason FROM judged",
    "q23_reject_counts": f"WITH {JUDGED} SELECT reject_reason, count(*) AS n FROM judged WHERE reject_reason IS NOT NULL GROUP BY ALL",
    "q24_confidence": f"WITH {SCORED} SELECT doc_id, round(confidence, 9) AS confidence FROM scored",
    "q25_tiers": f"WITH {SCORED} SELECT tier, loss_weight, count(*) AS n FROM scored GROUP BY ALL",
    "q26_overlap_cap": f"WITH {CAPPED} SELECT doc_id, has_overlap FROM capped",
    "q27_split_hash": f"WITH {TALK}, {TEST_CALLS.format(src='seg')} SELECT call_id, seg_idx, CASE WHEN call_id IN (SELECT call_id FROM test) THEN 'test' ELSE 'train' END AS split FROM seg",
    "q29_merge_gold": f"WITH {GOLD} SELECT id, md5(text) AS text_md5, tier, loss_weight, source FROM mixed",
    "q30_manifest_record": f"""WITH {MEASURED} SELECT doc_id, round(coalesce(clip_duration, greatest(0, "end" - 0.25::DOUBLE)), 3) AS duration, 0.25::DOUBLE AS extent_start, round("end", 3) AS extent_end FROM measured""",
    "q31_length_buckets": f"""WITH {MEASURED} SELECT CASE WHEN duration < 1 THEN 'under_min' WHEN duration > 28 THEN 'over_max' WHEN duration >= 3 AND duration < 8 THEN 'short'
  WHEN duration >= 8 AND duration < 18 THEN 'mid' ELSE 'long' END AS bucket, count(*) AS n FROM measured GROUP BY ALL""",
    "q32_duration_bands": f"""WITH {MEASURED}, b AS (SELECT CASE WHEN coalesce(clip_duration, 0) < 3 THEN '<3s' WHEN clip_duration < 8 THEN '3-8s' WHEN clip_duration < 18 THEN '8-18s' WHEN clip_duration <= 28 THEN '18-28s' ELSE '>28s' END AS band,
  count(*) AS n FROM measured GROUP BY ALL) SELECT *, round(100 * n / sum(n) OVER (), 6) AS percent FROM b""",
    "q33_conf_histogram": f"""WITH {SCORED}, b AS (SELECT printf('%.1f', trunc(confidence * 10) / 10) AS bucket, count(*) AS n FROM scored WHERE confidence IS NOT NULL GROUP BY ALL)
SELECT *, repeat('#', ((n * 40) // max(n) OVER ())::BIGINT) AS bar FROM b""",
    "q34_manifest_totals": f"WITH {MEASURED}, d AS (SELECT round(duration, 3) AS d FROM measured) SELECT count(*) AS n_records, round(sum(d) / 3600, 6) AS hours, round(avg(d), 6) AS mean_duration FROM d",
    "q34_source_counts": f"WITH {GOLD} SELECT coalesce(tier, '?') || '/' || coalesce(source, 'silver') AS tier_source, count(*) AS n FROM mixed GROUP BY ALL",
    "q35_turn_stats": f"""WITH {TALK}, d AS (SELECT *, greatest(0, "end" - "start") AS d FROM seg)
SELECT call_id, speaker, count(*) AS turns, round(sum(d), 6) AS speech_s, round(min(d), 6) AS min_s, round(median(d), 6) AS median_s, round(max(d), 6) AS max_s, count(*) FILTER (d < 5) AS n_short FROM d GROUP BY ALL""",
    "q36_json_extract": r"""WITH e AS (
  SELECT event_id, event_type, user_id % 4 AS shape, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 2 = 0 THEN event_id + 0.5::DOUBLE ELSE event_id::DOUBLE END AS "start", event_id % 10 AS o, props FROM events)
SELECT 'wav' || event_id AS stem, CASE shape WHEN 0 THEN 'A' || event_id WHEN 2 THEN 'R' || event_id ELSE 'wav' || event_id END AS call_id, CASE WHEN shape = 1 THEN 'good' END AS audio_quality,
  CASE WHEN shape < 3 THEN 0 END AS seg_idx, CASE WHEN shape < 3 THEN "start" END AS "start", CASE WHEN shape < 3 THEN (event_id + 7)::DOUBLE END AS "end", CASE WHEN shape < 3 THEN event_type END AS text,
  CASE WHEN shape < 3 THEN CASE WHEN event_id % 13 = 0 THEN '' ELSE event_type END END AS speaker, CASE WHEN shape < 3 THEN o IN (0, 2, 5, 8) END AS overlap, CASE WHEN shape < 3 THEN "start" IS NULL END AS bad_call FROM e""",
    "q37_pair_files": """WITH d AS (SELECT doc_id AS i, doc_id // 4 AS g FROM documents),
js AS (SELECT DISTINCT g, CASE WHEN g % 3 = 0 THEN i::VARCHAR ELSE 'report' END AS stem FROM d),
wav AS (SELECT g, i::VARCHAR AS stem FROM d WHERE i % 2 = 0 AND g % 5 <> 4 AND NOT (g % 3 = 1 AND i % 4 = 2)),
n AS (SELECT g, count(*) AS n, min(stem) AS lone FROM wav GROUP BY g)
SELECT '/c/' || js.g || '/' || js.stem || '.json' AS json_path,
  CASE WHEN wav.stem IS NOT NULL THEN '/c/' || js.g || '/' || wav.stem || '.wav' WHEN n = 1 THEN '/c/' || js.g || '/' || lone || '.wav' END AS wav_path,
  CASE WHEN wav.stem IS NOT NULL OR n = 1 THEN NULL WHEN n > 1 THEN 'ambiguous' ELSE 'no wav' END AS skip_reason
FROM js LEFT JOIN wav USING (g, stem) LEFT JOIN n USING (g)""",
    "q38_load_rows": f"WITH {MANIFEST} SELECT outcome, count(*) AS n FROM outcome GROUP BY ALL",
    "q38_training_rows": f"WITH {MANIFEST} SELECT resolved AS audio, md5(regexp_replace(text, '^{BLANK}+|{BLANK}+$', '', 'g')) AS text_md5, confidence::FLOAT::DOUBLE AS confidence FROM outcome WHERE outcome = 'kept'",
    "q39_build_stats": f"""WITH {CAPPED}, jud AS (SELECT doc_id, reject_reason FROM ({"WITH " + JUDGED + " FROM judged"})),
k AS (SELECT *, (doc_id // 10)::VARCHAR AS call_id FROM capped), {TEST_CALLS.format(src="k")},
rej AS (SELECT string_agg(reject_reason || '=' || n, ',' ORDER BY reject_reason) AS rejected FROM (SELECT reject_reason, count(*) AS n FROM jud WHERE reject_reason IS NOT NULL GROUP BY ALL)),
tie AS (SELECT string_agg(tier || '=' || n, ',' ORDER BY tier) AS tiers FROM (SELECT tier, count(*) AS n FROM k GROUP BY ALL))
SELECT (SELECT count(*) FROM documents) AS calls, (SELECT count(*) FROM documents WHERE doc_id % 29 = 0) AS calls_skipped, (SELECT count(*) FROM jud WHERE reject_reason IS NULL) AS chunks_kept,
  count(*) AS after_overlap_cap, count(*) FILTER (call_id NOT IN (FROM test)) AS train, count(*) FILTER (call_id IN (FROM test)) AS test, count(*) FILTER (tier = 'review') AS review_queue,
  (SELECT rejected FROM rej) AS rejected, (SELECT tiers FROM tie) AS tiers FROM k""",
    "q41_clips_tsv": f"""WITH RECURSIVE {TALK_CHUNKS}
SELECT concat_ws('_', call_id, speaker, group_idx) || chr(9) || (CASE WHEN has_overlap THEN 'review' ELSE '?' END) || '(' || printf('%.2f', CASE WHEN overlap_fraction > 0 THEN 1 - overlap_fraction / 2 ELSE 0::DOUBLE END) || ')' || chr(9) || text AS value
FROM talk WHERE group_idx % 2 = 0""",
    "q42_safe_id": r"SELECT page_id, substr(regexp_replace(url, '[^\p{L}\p{N}]', '_', 'g'), 1, 80) AS safe_id, replace(substr(html, 1, 45), chr(10), ' ') AS preview FROM pages",
    "q43_limit_calls": f"""WITH p AS (SELECT {list(FOLDERS)}[page_id % {len(FOLDERS)} + 1] || '/' || url AS json_path, page_id FROM pages)
SELECT json_path, min(page_id) AS page_id FROM p GROUP BY json_path ORDER BY string_split(json_path, '/') LIMIT 25""",
    "q44_ref_text": f"""WITH {TALK} SELECT call_id, speaker, trim(string_agg(text, ' ' ORDER BY "start", seg_idx)) AS ref_text FROM seg WHERE text <> '' AND speaker <> '' GROUP BY ALL""",
    "q45_edge_words": f"""WITH {WORDS}, b AS (SELECT call_id, min(word_idx) FILTER (score >= 0.65::DOUBLE) AS lo, max(word_idx) FILTER (score >= 0.65::DOUBLE) AS hi FROM words GROUP BY ALL)
SELECT call_id, count(*) FILTER (word_idx BETWEEN lo AND hi) AS n_kept, any_value(lo)::INT AS first_idx, any_value(hi)::INT AS last_idx FROM words JOIN b USING (call_id) GROUP BY ALL""",
    "q46_resolve_path": f"WITH {MANIFEST} SELECT DISTINCT audio_path, resolved FROM resolved WHERE audio_path IS NOT NULL",
}

#: The best path by recursion over frames: each row carries the score and the states so far of all seven states.
_SAME["q47_ctc_align"] = """WITH RECURSIVE em AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, [0, label % 3 + 1, 0, (label // 3) % 3 + 1, 0, label % 2 + 1, 0] AS own FROM embeddings),
st AS (
  SELECT vec_id, 0 AS t, e, own, list_transform(range(1, 8), lambda s: {'v': CASE WHEN s <= 2 THEN e[own[s] + 1] ELSE '-infinity'::DOUBLE END, 'p': [s]}) AS c FROM em
  UNION ALL
  SELECT vec_id, t + 1, e, own, list_transform(range(1, 8), lambda s: {
      'v': greatest(c[s].v, CASE WHEN s > 1 THEN c[s - 1].v ELSE '-infinity'::DOUBLE END, CASE WHEN s > 2 AND s % 2 = 0 AND own[s] <> own[s - 2] THEN c[s - 2].v ELSE '-infinity'::DOUBLE END) + e[4 * (t + 1) + own[s] + 1],
      'p': list_append(CASE
          WHEN s = 1 OR c[s].v >= greatest(c[s - 1].v, CASE WHEN s > 2 AND s % 2 = 0 AND own[s] <> own[s - 2] THEN c[s - 2].v ELSE '-infinity'::DOUBLE END) THEN c[s].p
          WHEN s = 2 OR s % 2 = 1 OR own[s] = own[s - 2] OR c[s - 1].v >= c[s - 2].v THEN c[s - 1].p ELSE c[s - 2].p END, s)})
  FROM st WHERE t < 15),
best AS (SELECT vec_id, CASE WHEN c[7].v >= c[6].v THEN c[7] ELSE c[6] END AS b FROM st WHERE t = 15)
SELECT vec_id, b.v AS score, array_to_string([list_position(b.p, s) - 1 FOR s IN [2, 4, 6]], ',') AS "first",
       array_to_string([16 - list_position(list_reverse(b.p), s) + 1 FOR s IN [2, 4, 6]], ',') AS "end" FROM best"""


def oracle_sql() -> dict[str, str]:
    return dict(_SAME)
