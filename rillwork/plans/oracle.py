"""DuckDB SQL for the record-linkage queries."""

from __future__ import annotations

from rillwork.operators.blocking import BLOCKS
from rillwork.operators.features import EQUAL, OVERLAP, FEATURES
from rillwork.operators.normalize import ADDRESS_FORMS, NAME_FORMS
from rillwork.operators.scoring import LINEAR
from rillwork.plans.queries import FIXTURE_THRESHOLD, REPORTED

_PAIR = "source1_entity_id, candidate_entity_id"


def _fold(x: str) -> str:
    """Case folding of the tables' alphabets."""
    return f"replace(lower(coalesce({x}, '')), 'ß', 'ss')"


def _forms(column: str, wanted: list[str]) -> str:
    f = f"{column}_folded"
    norm, compact = f"trim(regexp_replace({f}, '[^a-z0-9]+', ' ', 'g'))", f"regexp_replace({f}, '[^a-z0-9]+', '', 'g')"
    numbers = f"regexp_extract_all({f}, '\\p{{Nd}}+')"
    sql = {
        "norm": norm,
        "compact": compact,
        "alnum": compact,
        "tokens": norm,
        "sorted_tokens": f"array_to_string(list_sort(string_split({norm}, ' ')), ' ')",
        "alpha_tokens": f"array_to_string(list_filter(string_split({norm}, ' '), lambda t: regexp_full_match(t, '[a-z]+')), ' ')",
        "numeric_tokens": f"array_to_string({numbers}, ' ')",
        "house_number": f"regexp_extract({f}, '\\p{{Nd}}+')",
        "postal_tokens": f"array_to_string(list_filter({numbers}, lambda t: length(t) >= 4), ' ')",
    }
    return ", ".join(f"{sql[k]} AS {column}_{k}" for k in wanted)


def _key(b) -> str:
    return f"substring({b.column}, 1, {b.prefix})" if b.prefix else b.column


def _capped(side: str, key: str, cap: int) -> str:
    return f"(SELECT entity_id, {key} AS k FROM {side} WHERE {key} <> '' QUALIFY count(*) OVER (PARTITION BY {key}) <= {cap})"


def _block(b, target: str, cap: int | None = None) -> str:
    cap = cap or b.cap
    return (
        f"SELECT x.entity_id AS source1_entity_id, y.entity_id AS candidate_entity_id, '{b.name}' AS block_name "
        f"FROM {_capped('n1', _key(b), cap)} x JOIN {_capped(target, _key(b), cap)} y ON x.k = y.k AND x.entity_id <> y.entity_id"
    )


def _raw(target: str, cap: int | None = None) -> str:
    return " UNION ALL ".join(_block(b, target, cap) for b in BLOCKS)


def _found(raw: str, source: str) -> str:
    return f"SELECT {_PAIR}, '{source}' AS candidate_source, CAST(count(DISTINCT block_name) AS INT) AS block_support_count, array_to_string(list_sort(list(DISTINCT block_name)), ',') AS blocks FROM {raw} GROUP BY {_PAIR}"


def _features(nulls: bool) -> str:
    v = (lambda c: f"coalesce({c}, '')") if nulls else (lambda c: c)
    sql = {f: f"CAST({v(f's1.{c}')} = {v(f's2.{c}')} AS INT)" for f, c in EQUAL.items()}
    split = lambda c: f"string_split(trim(coalesce({c}, '')), ' ')"
    sql |= {f: f"len(list_intersect({split(f's1.{c}')}, {split(f's2.{c}')}))" for f, c in OVERLAP.items()}
    n = {(s, w): f"coalesce(length({s}.business_{w}_norm), 0)" for s in ("s1", "s2") for w in ("name", "address")}
    sql |= {"block_support_count_feature": "p.block_support_count"}
    sql |= {f"{s}_{w}_len": x for (s, w), x in n.items()}
    sql |= {f"{w}_length_diff": f"abs({n['s1', w]} - {n['s2', w]})" for w in ("name", "address")}
    return ", ".join(f"CAST(coalesce({sql[f]}, 0) AS INT) AS {f}" for f in FEATURES)


_N = "nullif(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1), '')"
_BASE = f"""
docs AS (SELECT *, coalesce(CAST({_N} AS INT) % 3 + 1, 1) AS n FROM documents),
named AS (SELECT *, 'S' || n || '-' || doc_id AS entity_id, regexp_extract(text, '^[^.\\n]*') AS business_name FROM docs),
ent AS (SELECT entity_id, n, business_name, CASE WHEN substring(text, length(business_name) + 1) <> '' THEN concat_ws(' ', n_chars, substring(text, length(business_name) + 1), lang) END AS business_address, lang AS country FROM named),
folded AS (SELECT *, {_fold("business_name")} AS business_name_folded, {_fold("business_address")} AS business_address_folded, trim(regexp_replace(coalesce(country, ''), '\\s+', ' ', 'g')) AS country_norm FROM ent),
norm AS MATERIALIZED (SELECT entity_id, n, country_norm, {_forms("business_name", NAME_FORMS)}, {_forms("business_address", ADDRESS_FORMS)} FROM folded),
n1 AS (SELECT * FROM norm WHERE n = 1), n2 AS (SELECT * FROM norm WHERE n = 2), n3 AS (SELECT * FROM norm WHERE n = 3),
raw2 AS ({_raw("n2")}), raw3 AS ({_raw("n3")}),
found2 AS ({_found("raw2", "s2")}), found3 AS ({_found("raw3", "s3")}),
found AS (SELECT * FROM found2 UNION ALL SELECT * FROM found3),
whole AS (SELECT n, entity_id, nullif(regexp_replace({_fold("text")}, '[^a-z0-9]+', '', 'g'), '') AS w FROM named),
gt AS (SELECT x.entity_id AS source1_entity_id, string_agg(DISTINCT y.entity_id, ',' ORDER BY y.entity_id) AS matched_entity_ids FROM whole x LEFT JOIN whole y ON y.n <> 1 AND x.w = y.w WHERE x.n = 1 GROUP BY x.entity_id),
truth AS (SELECT DISTINCT source1_entity_id, unnest(string_split(matched_entity_ids, ',')) AS candidate_entity_id FROM gt WHERE matched_entity_ids IS NOT NULL),
true_by AS (SELECT *, lower(substring(candidate_entity_id, 1, 2)) AS candidate_source FROM truth),
scored AS (SELECT *, least(100, greatest(0, {" + ".join(f"{f} * {w}" for f, w in LINEAR.items())})) / 100.0::DOUBLE AS match_probability
  FROM (SELECT p.source1_entity_id, p.candidate_entity_id, p.candidate_source, {_features(True)} FROM found p JOIN norm s1 ON s1.entity_id = p.source1_entity_id JOIN norm s2 ON s2.entity_id = p.candidate_entity_id)),
labelled AS (SELECT scored.*, CAST(t.source1_entity_id IS NOT NULL AS INT) AS label FROM scored LEFT JOIN truth t USING ({_PAIR})),
predicted AS (SELECT * FROM scored WHERE match_probability >= {FIXTURE_THRESHOLD}),
pairs_out AS (SELECT {_PAIR}, min(candidate_source) AS candidate_source FROM predicted GROUP BY {_PAIR}),
results AS (SELECT entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT candidate_entity_id, ',' ORDER BY candidate_entity_id), '') AS matched_entity_ids FROM ent LEFT JOIN pairs_out ON entity_id = source1_entity_id WHERE n = 1 GROUP BY entity_id),
held AS (SELECT source1_entity_id, CASE WHEN row_number() OVER (ORDER BY md5(source1_entity_id), source1_entity_id) <= floor(count(*) OVER () * 0.2) THEN 'validation' ELSE 'train' END AS split FROM (SELECT DISTINCT source1_entity_id FROM gt)),
sets AS (SELECT g.source1_entity_id, coalesce(p.ids, []) AS predicted_ids, coalesce(t.ids, []) AS actual_ids FROM gt g
  LEFT JOIN (SELECT source1_entity_id, list(DISTINCT candidate_entity_id) AS ids FROM predicted GROUP BY ALL) p USING (source1_entity_id)
  LEFT JOIN (SELECT source1_entity_id, list(candidate_entity_id) AS ids FROM truth GROUP BY ALL) t USING (source1_entity_id)),
counted AS (SELECT source1_entity_id, len(list_intersect(predicted_ids, actual_ids)) AS tp, len(predicted_ids) AS n_predicted, len(actual_ids) AS n_actual FROM sets),
rated AS (SELECT source1_entity_id, tp, n_predicted - tp AS fp, n_actual - tp AS fn, n_predicted, n_actual,
  CASE WHEN n_predicted = 0 AND n_actual = 0 THEN 1.0 WHEN n_predicted = 0 THEN 0.0 ELSE tp::DOUBLE / n_predicted END AS p,
  CASE WHEN n_actual = 0 THEN 1.0 ELSE tp::DOUBLE / n_actual END AS r FROM counted),
by_entity AS (SELECT *, CASE WHEN n_predicted = 0 AND n_actual = 0 THEN 1.0 WHEN 0.25 * p + r = 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END AS f FROM rated),
positives AS (SELECT {_PAIR}, block_support_count FROM truth JOIN found USING ({_PAIR})),
negatives AS (SELECT {_PAIR}, block_support_count FROM found ANTI JOIN truth USING ({_PAIR}) QUALIFY row_number() OVER (ORDER BY md5(source1_entity_id || '|' || candidate_entity_id), {_PAIR}) <= least(8000000, (SELECT count(*) FROM positives)))
"""


def _metrics(entities: str) -> str:
    return f"""
    SELECT entities, round(macro, 6) AS macro_f05, tp, fp, fn, actual_nonzero, predicted_nonzero, correct_zero_match,
      round(p, 6) AS micro_precision, round(r, 6) AS micro_recall, round(CASE WHEN 0.25 * p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END, 6) AS micro_f05
    FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS r FROM (
      SELECT count(*) AS entities, avg(round(f, 6)) AS macro, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
        count(*) FILTER (WHERE n_actual > 0) AS actual_nonzero, count(*) FILTER (WHERE n_predicted > 0) AS predicted_nonzero, count(*) FILTER (WHERE n_actual = 0 AND n_predicted = 0) AS correct_zero_match
      FROM by_entity {entities}))"""


_SWEEP = """
    SELECT threshold, tp, fp, positives - tp AS fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN 0.25 * p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END, 6) AS f05
    FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS p, CASE WHEN positives = 0 THEN 0.0 ELSE tp::DOUBLE / positives END AS r
      FROM (SELECT k / 100.0::DOUBLE AS threshold, count(*) FILTER (WHERE hundredths >= k AND label = 1) AS tp, count(*) FILTER (WHERE hundredths >= k AND label = 0) AS fp, count(*) FILTER (WHERE label = 1) AS positives
        FROM range(5, 96) t(k) LEFT JOIN (SELECT CAST(round(match_probability * 100) AS INT) AS hundredths, label FROM labelled) ON true GROUP BY k))"""


def _stats(k: int) -> str:
    each = "".join(f"SELECT 's{k}' AS candidate_source, '{b.name}' AS block_name, (SELECT count(*) FROM raw{k} WHERE block_name = '{b.name}') AS raw_pairs, NULL::BIGINT AS distinct_pairs, NULL::DOUBLE AS reduction_percent UNION ALL " for b in BLOCKS)
    return each + f"SELECT 's{k}', 'total', (SELECT count(*) FROM raw{k}), (SELECT count(*) FROM found{k}), (SELECT CASE WHEN r > 0 THEN round(100.0::DOUBLE * (r - d) / r, 6) ELSE 0 END FROM (SELECT (SELECT count(*) FROM raw{k}) AS r, (SELECT count(*) FROM found{k}) AS d))"


def _train_features() -> str:
    every = f"(SELECT *, 1 AS label FROM positives UNION ALL SELECT *, 0 AS label FROM negatives)"
    return f"SELECT p.source1_entity_id, p.candidate_entity_id, p.label, {_features(False)} FROM {every} p LEFT JOIN norm s1 ON s1.entity_id = p.source1_entity_id LEFT JOIN norm s2 ON s2.entity_id = p.candidate_entity_id"


def _audit(c: str) -> str:
    return f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} IS NULL OR regexp_full_match({c}, '\\s*')) AS blanks, count(DISTINCT {c}) AS distinct_values, max(length({c})) AS max_length FROM ent"


def _lengths(c: str) -> str:
    n = f"length(coalesce({c}, ''))"
    return f"SELECT '{c}' AS column_name, min({n}) AS min_length, max({n}) AS max_length, round(avg({n}), 6) AS mean_length, round(quantile_cont({n}, 0.5), 6) AS median_length, round(quantile_cont({n}, 0.25), 6) AS p25_length, round(quantile_cont({n}, 0.75), 6) AS p75_length FROM ent"


def _rules() -> str:
    matched = "(SELECT source1_entity_id, unnest(string_split(matched_entity_ids, ',')) AS candidate_entity_id FROM results WHERE matched_entity_ids <> '')"
    extra = lambda table, keys: f"SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM {table} GROUP BY {keys})"
    ids = lambda n: f"(SELECT entity_id FROM ent WHERE n = {n})"
    rules = {
        "s1_null_ids": f"SELECT count(*) FROM {ids(1)} WHERE entity_id IS NULL",
        **{f"s{n}_duplicate_ids": extra(ids(n), "entity_id") for n in (1, 2, 3)},
        "s2_s3_shared_ids": f"SELECT count(*) FROM ({ids(2)} INTERSECT {ids(3)})",
        "pair_null_values": f"SELECT count(*) FROM pairs_out WHERE source1_entity_id IS NULL OR candidate_entity_id IS NULL OR candidate_source IS NULL",
        "pair_unknown_source": "SELECT count(*) FROM pairs_out WHERE candidate_source NOT IN ('s2', 's3')",
        "pair_unknown_s1": f"SELECT count(DISTINCT source1_entity_id) FROM pairs_out WHERE source1_entity_id NOT IN {ids(1)}",
        **{f"pair_unknown_s{n}": f"SELECT count(DISTINCT candidate_entity_id) FROM pairs_out WHERE candidate_source = 's{n}' AND candidate_entity_id NOT IN {ids(n)}" for n in (2, 3)},
        "pair_duplicates": extra("pairs_out", _PAIR),
        "result_missing_s1": f"SELECT count(*) FROM {ids(1)} WHERE entity_id NOT IN (SELECT source1_entity_id FROM results)",
        "result_extra_s1": f"SELECT count(*) FROM results WHERE source1_entity_id NOT IN {ids(1)}",
        "result_duplicate_s1": extra("results", "source1_entity_id"),
        "matched_unknown_ids": f"SELECT count(DISTINCT candidate_entity_id) FROM {matched} WHERE candidate_entity_id NOT IN (SELECT entity_id FROM ent WHERE n <> 1)",
        "matched_duplicate_ids": extra(matched, _PAIR),
        "matched_not_in_pairs": f"SELECT count(*) FROM {matched} ANTI JOIN pairs_out USING ({_PAIR})",
        "zero_match_mismatch": "SELECT count(*) FROM results WHERE matched_entity_ids = '' AND source1_entity_id IN (SELECT source1_entity_id FROM pairs_out)",
    }
    return " UNION ALL ".join(f"SELECT '{k}' AS rule, CAST(({v}) AS BIGINT) AS violations" for k, v in rules.items())


def _report() -> str:
    ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0 END"
    cells = f"""SELECT count(*) FILTER (WHERE label = 0 AND NOT hit)::DOUBLE AS tn, count(*) FILTER (WHERE label = 0 AND hit)::DOUBLE AS fp, count(*) FILTER (WHERE label = 1 AND NOT hit)::DOUBLE AS fn, count(*) FILTER (WHERE label = 1 AND hit)::DOUBLE AS tp
      FROM (SELECT label, match_probability >= {FIXTURE_THRESHOLD} AS hit FROM labelled)"""
    rates = f"SELECT *, {ratio('tn', '(tn + fn)')} AS p0, {ratio('tn', '(tn + fp)')} AS r0, {ratio('tp', '(tp + fp)')} AS p1, {ratio('tp', '(tp + fn)')} AS r1, tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n, {ratio('(tn + tp)', '(tn + fp + fn + tp)')} AS acc FROM ({cells})"
    all_ = f"SELECT *, {ratio('2 * p0 * r0', '(p0 + r0)')} AS f0, {ratio('2 * p1 * r1', '(p1 + r1)')} AS f1 FROM ({rates})"
    w = lambda x: ratio(f"({x}0 * s0 + {x}1 * s1)", "n")
    rows = [("0", "p0", "r0", "f0", "s0"), ("1", "p1", "r1", "f1", "s1"), ("accuracy", "acc", "acc", "acc", "n"), ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"), ("weighted avg", w("p"), w("r"), w("f"), "n")]
    return " UNION ALL ".join(f"SELECT '{c}' AS class, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1, CAST({s} AS BIGINT) AS support FROM ({all_})" for c, p, r, f, s in rows)


_SELECT = {
    "normalize_name": f"SELECT entity_id, {', '.join(f'business_name_{k}' for k in NAME_FORMS)} FROM norm",
    "normalize_address": f"SELECT entity_id, {', '.join(f'business_address_{k}' for k in ADDRESS_FORMS)} FROM norm",
    # The tables have no compatibility characters, on which NFC and NFKC differ.
    "unicode_names": "SELECT entity_id, nfc_normalize(coalesce(business_name, '')) AS business_name_nfkc FROM ent",
    "normalize_country": "SELECT entity_id, country_norm FROM norm",
    **{f"block_{b.name}": f"SELECT * FROM raw2 WHERE block_name = '{b.name}'" for b in BLOCKS},
    "block_size_filter": f"SELECT entity_id, k AS name_prefix4 FROM {_capped('n1', _key(BLOCKS[4]), BLOCKS[4].cap)}",
    "candidates_s2": "SELECT * FROM found2",
    "candidates_s3": "SELECT * FROM found3",
    "candidates_none": "SELECT * FROM found2 WHERE false",
    "candidate_stats": f"{_stats(2)} UNION ALL {_stats(3)}",
    "ground_truth": "SELECT * FROM gt",
    "gt_pairs": f"SELECT {_PAIR} FROM truth",
    "gt_zero_match": "SELECT source1_entity_id FROM gt WHERE matched_entity_ids IS NULL",
    "gt_split_by_source": f"SELECT {_PAIR}, candidate_source FROM true_by",
    "gt_match_stats": """SELECT count(*) AS entities, count(*) FILTER (WHERE m = 0) AS zero_match, count(*) FILTER (WHERE m = 1) AS single_match, count(*) FILTER (WHERE m > 1) AS multi_match, max(m) AS max_matches, round(avg(m), 6) AS mean_matches
        FROM (SELECT coalesce(len(string_split(matched_entity_ids, ',')), 0) AS m FROM gt)""",
    "recall_by_source": f"""SELECT coalesce(candidate_source, 'overall') AS candidate_source, count(*) AS true_pairs, count(f) AS retrieved_pairs, count(*) - count(f) AS missed_pairs, CASE WHEN count(*) > 0 THEN round(count(f)::DOUBLE / count(*), 6) ELSE 0 END AS recall
        FROM (SELECT t.candidate_source, f.source1_entity_id AS f FROM true_by t LEFT JOIN (SELECT DISTINCT {_PAIR} FROM found) f USING ({_PAIR})) GROUP BY ROLLUP (candidate_source)""",
    "missed_pairs": f"SELECT {_PAIR}, candidate_source FROM true_by ANTI JOIN (SELECT DISTINCT {_PAIR} FROM found) USING ({_PAIR})",
    "missed_pairs_report": f"SELECT {_PAIR}, candidate_source FROM true_by ANTI JOIN (SELECT {_PAIR} FROM ({_block(BLOCKS[1], 'n2', None)} UNION ALL {_block(BLOCKS[1], 'n3', None)})) USING ({_PAIR}) ORDER BY ALL LIMIT {REPORTED}",
    "gt_reconciliation": f"""SELECT count(*) AS true_pairs, count(*) FILTER (WHERE n > 0) AS held_pairs, count(*) FILTER (WHERE n > 1) AS shared_pairs, count(*) FILTER (WHERE n = 0) AS lost_pairs
        FROM (SELECT {_PAIR}, count(DISTINCT candidate_source) AS n FROM (SELECT DISTINCT {_PAIR} FROM truth) LEFT JOIN true_by USING ({_PAIR}) GROUP BY ALL)""",
    "sample_values": f"SELECT DISTINCT business_name FROM ent WHERE business_name IS NOT NULL ORDER BY business_name LIMIT {REPORTED}",
    "source_id_overlap": "SELECT count(*) AS shared_ids FROM (SELECT entity_id FROM ent WHERE n = 2 INTERSECT SELECT entity_id FROM ent WHERE n = 3)",
    "positive_pairs": "SELECT * FROM positives",
    "negative_sample": "SELECT * FROM negatives",
    "shuffled_pairs": f"""SELECT {_PAIR}, label, row_number() OVER (ORDER BY md5(source1_entity_id || '|' || candidate_entity_id), {_PAIR}) AS place
        FROM (SELECT {_PAIR}, 1 AS label FROM positives UNION ALL SELECT {_PAIR}, 0 AS label FROM negatives)""",
    "pair_features_train": _train_features(),
    "pair_features_score": f"SELECT {_PAIR}, candidate_source, {', '.join(FEATURES)} FROM scored WHERE candidate_source = 's2'",
    "entity_split": "SELECT * FROM held",
    "scored_pairs": f"SELECT {_PAIR}, candidate_source, match_probability FROM scored",
    "threshold_sweep": _SWEEP,
    "best_threshold": f"SELECT * FROM ({_SWEEP}) ORDER BY f05 DESC, threshold LIMIT 1",
    "classification_report": _report(),
    "entity_f05": "SELECT source1_entity_id, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f05, n_predicted, n_actual FROM by_entity",
    "entity_metrics": _metrics(""),
    "validation_metrics": _metrics("JOIN held USING (source1_entity_id) WHERE split = 'validation'"),
    "candidate_pairs_out": "SELECT * FROM pairs_out",
    "ordered_pairs_out": f"SELECT *, row_number() OVER (ORDER BY source1_entity_id, candidate_source, candidate_entity_id) AS place FROM pairs_out",
    "matching_results": "SELECT * FROM results",
    "match_distribution": "SELECT CASE WHEN matched_entity_ids = '' THEN 0 ELSE len(string_split(matched_entity_ids, ',')) END AS n_matches, count(*) AS entities FROM results GROUP BY 1",
    "validation_rules": _rules(),
    "audit_columns": " UNION ALL ".join(map(_audit, ("entity_id", "business_name", "business_address", "country"))),
    "id_profile": """SELECT CAST(sum(c) AS BIGINT) AS rows, count(entity_id) AS distinct_ids, CAST(sum(c - 1) AS BIGINT) AS extra_copies, CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS rows_with_shared_id, CAST(coalesce(sum(c) FILTER (WHERE entity_id IS NULL), 0) AS BIGINT) AS null_ids
        FROM (SELECT entity_id, count(*) AS c FROM ent GROUP BY entity_id)""",
    "text_length_profile": " UNION ALL ".join(map(_lengths, ("business_name", "business_address"))),
    "country_counts": "SELECT coalesce(trim(country), '<NULL>') AS value, count(*) AS rows FROM ent GROUP BY 1",
    "duplicate_rows": "SELECT CAST(sum(c) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS c FROM ent GROUP BY business_name, business_address, country)",
    "blank_addresses": "SELECT entity_id FROM ent WHERE business_address IS NULL OR regexp_full_match(business_address, '\\s*')",
}

ORACLE: dict[str, str] = {name: f"WITH {_BASE} {select}" for name, select in _SELECT.items()}
