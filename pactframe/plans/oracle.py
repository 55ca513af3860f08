"""SQL twins of the registered queries, written from the rules and from how the views were built."""

from __future__ import annotations

from pactframe.schemas import PRODUCT_COLUMNS

ORACLE: dict[str, str] = {}

PERIODS = "['Mensuelle', 'Trimestrielle', 'Semestrielle', 'Annuelle', NULL]"

VIEWS = {
    "paths_v": """
        SELECT *, upper(left(lang, 1)) || '/co_' || lang || '/' || source || '/'
          || ['CADRE', 'CP', 'AVENANT-' || (doc_id % 4), 'CONTRAT-SAAS', 'CG-AVENANT-1', 'CP-ASP-x'][CAST((doc_id // 20) % 6 + 1 AS INT)]
          || '-' || doc_id || CASE WHEN doc_id % 11 = 0 THEN '.PDF' ELSE '.pdf' END AS path
        FROM documents""",
    "docs_v": """
        SELECT replace(path, '/', '_') AS id, path, text AS content, lang AS language, 1 + n_chars // 1800 AS page_count,
          (doc_id // 20) % 6 AS kind, doc_id % 11 <> 0 AS lower_pdf
        FROM paths_v""",
    "affairs_v": "SELECT DISTINCT source AS affair_id FROM documents",
    "matched_v": """
        SELECT a.affair_id, d.* FROM docs_v d JOIN affairs_v a ON d.id ILIKE '%' || a.affair_id || '%' WHERE d.lower_pdf AND kind <> 5""",
    "products_v": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS affair_id, l_linenumber > 4 AS is_av,
          l_orderkey || CASE WHEN l_linenumber > 4 THEN '|AV|' || (l_linenumber - 4) ELSE '|CGCP' END AS request_id,
          CAST(row_number() OVER (PARTITION BY l_orderkey, CASE WHEN l_linenumber > 4 THEN l_linenumber - 4 ELSE 0 END
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_tax) - 1 AS INT) AS pos,
          CASE WHEN l_linenumber > 4 THEN CAST(l_shipdate AS DATE) ELSE CAST(o_orderdate AS DATE) END AS signed,
          'Client ' || o_custkey AS company_name,
          strftime(o_orderdate, '%Y%m') || CASE WHEN o_orderpriority = '1-URGENT' THEN '/' ELSE '-' END || o_custkey AS numero_de_contrat,
          CASE WHEN l_linenumber <= 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS signature_date_cp,
          CASE WHEN l_linenumber > 4 THEN strftime(l_shipdate, '%d/%m/%Y') END AS signature_date_av,
          CASE WHEN l_linenumber > 4 THEN l_linenumber - 4 END AS avenant_number,
          CASE WHEN l_tax = 0 THEN NULL ELSE p_type END AS product_code,
          CASE l_linenumber WHEN 6 THEN p_name || 's' WHEN 7 THEN p_name[1:1] || p_name[3:] ELSE p_name END AS product_name,
          CASE WHEN l_partkey % 7 <> 0 THEN 12 * (1 + l_partkey % 5) END AS duree_mois,
          CASE WHEN l_partkey % 77 = 0 THEN '99999999999 mois' WHEN l_partkey % 7 <> 0 THEN (12 * (1 + l_partkey % 5)) || ' mois' END AS duree_de_service,
          CASE WHEN l_suppkey % 2 <> 0 THEN NULL ELSE '+ prorata de la période en cours' END AS duree_de_service_notes,
          o_orderstatus = 'P' AS reconduction_tacite,
          ['À échoir', 'Échu', 'Annuel'][CAST(l_linenumber % 3 + 1 AS INT)] AS term_mode,
          {PERIODS}[CAST(l_partkey % 5 + 1 AS INT)] AS billing_frequency,
          CASE WHEN l_linenumber = 3 THEN 'virement,bitcoin' ELSE 'virement' END AS payment_methods,
          CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price_unitaire,
          l_quantity AS quantity, {PERIODS}[CAST(l_suppkey % 4 + 1 AS INT)] AS quantity_periodicity,
          l_linestatus = 'O' AS is_volume_product, l_extendedprice AS loyer,
          CASE l_suppkey % 10 WHEN 0 THEN 'USD' WHEN 1 THEN 'XAF' ELSE 'EUR' END AS devise_de_facturation,
          {PERIODS}[CAST(l_linenumber % 5 + 1 AS INT)] AS loyer_periodicity,
          l_returnflag = 'R' AS one_shot_service, 'HT' AS tax_basis, l_discount = 0 AS is_included,
          CASE WHEN l_partkey % 3 = 0 THEN '0.05' END AS usage_overconsumption_price,
          CAST(4 * l_quantity AS INT) AS notes_words,
          ['fixed_rate', 'index_formula', 'Syntec', NULL][CAST(l_linenumber % 4 + 1 AS INT)] AS reval_method,
          CASE WHEN l_tax < CAST(0.04 AS DOUBLE) THEN NULL ELSE 'PU ' || CAST(l_quantity AS INT) || ' x' END AS evidence_price,
          CASE WHEN l_suppkey % 2 <> 0 THEN 'tarif 0.05 EUR' END AS evidence_usage,
          CASE WHEN l_suppkey % 3 <> 0 THEN 'révision par Syntec' END AS evidence_revalorization,
          CASE WHEN l_partkey % 2 <> 0 THEN 'facture Mensuelle' END AS evidence_billing,
          CASE WHEN l_partkey % 3 <> 0 THEN 'signé le ' || strftime(o_orderdate, '%Y-%m-%d') END AS evidence_dates,
          CASE WHEN l_suppkey % 2 <> 0 THEN 'avenant 1' END AS evidence_avenant,
          CASE WHEN l_partkey % 10 = 0 THEN 'prix manquant; ' || repeat('x', CAST(130 + l_suppkey % 20 AS INT)) END AS evidence_contract_errors,
          l_linenumber / CAST(10 AS DOUBLE) AS confidence_usage, l_linenumber / CAST(8 AS DOUBLE) AS confidence_revalorization,
          l_linenumber / CAST(10 AS DOUBLE) AS confidence_billing, CASE WHEN l_linenumber <> 1 THEN CAST(1 AS DOUBLE) END AS confidence_dates,
          CASE WHEN l_linenumber = 2 THEN CAST(0.95 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS confidence_company,
          CAST(0.9 AS DOUBLE) AS confidence_avenant, CAST(130 + l_suppkey % 20 AS INT) AS error_chars
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "seq_v": """
        SELECT *, row_number() OVER (PARTITION BY affair_id ORDER BY is_av, signed NULLS LAST, avenant_number NULLS LAST, request_id, pos) AS seq
        FROM products_v""",
    "consolidated_v": """
        SELECT *, row_number() OVER (PARTITION BY affair_id ORDER BY signed NULLS LAST, is_av, avenant_number NULLS LAST, request_id, pos) AS seq
        FROM products_v""",
    "answers_v": """
        SELECT *, CAST(event_id AS VARCHAR) AS request_id, CAST(user_id AS VARCHAR) AS affair_id,
          CASE WHEN event_id % 97 = 0 AND event_id % 194 <> 0 THEN 'truncated' WHEN event_type = 'error' AND event_id % 89 <> 0 THEN 'no_products' ELSE 'ok' END AS status,
          1000 + event_id % 5000 AS prompt_tokens, 200 + event_id % 700 AS completion_tokens
        FROM events""",
    # the lines each text was built from, one row per line, with what the rules must read in it
    "items_v": """
        SELECT CAST(l_orderkey AS VARCHAR) AS affair_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
          p_name, l_linenumber AS ln, l_returnflag AS rf, l_suppkey % 9 AS sheet, CAST(l_quantity AS INT) AS count, l_extendedprice AS price, l_quantity AS units,
          CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
          row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag) AS row_id
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "money_v": """
        SELECT *, CASE WHEN cents // 100 >= 1000 THEN (cents // 100000) || ' ' || lpad(CAST(cents // 100 % 1000 AS VARCHAR), 3, '0')
          ELSE CAST(cents // 100 AS VARCHAR) END || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS money
        FROM items_v""",
    "text_lines_v": """
        SELECT affair_id, id, row_id, ln, 0 AS part,
          p_name || ' ' || money || ' € HT' || CASE ln % 3 WHEN 0 THEN ' / mois' WHEN 1 THEN ' par an' ELSE '' END AS line FROM money_v
        UNION ALL
        SELECT affair_id, id, row_id, ln, 1, 'Licence ' || CAST(units AS INT) || ',00 EUR ' || money || ' EUR TTC' FROM money_v WHERE rf = 'A'
        UNION ALL
        SELECT affair_id, id, row_id, ln, 2, CASE ln WHEN 1 THEN 'Total ' || money || ' € HT' WHEN 2 THEN 'SLA Standard Inclus'
          WHEN 3 THEN 'Total abonnement, montant forfaitaire mensuel total de : ' || money || ' €'
          WHEN 4 THEN 'REMISE COMMERCIALE -' || money || ' € HT' WHEN 5 THEN 'Utilisateur supplémentaire 10 € / mois'
          WHEN 6 THEN 'palier S1, unité d’œuvre surcotée de 15%' WHEN 7 THEN 'Hypercare Gratuit' END FROM money_v
        UNION ALL
        SELECT affair_id, id, row_id, ln, 3, 'Option étendue' FROM money_v WHERE rf = 'N'
        UNION ALL
        SELECT affair_id, id, row_id, ln, 4, money || ' € HT / mois' FROM money_v WHERE rf = 'N'
        UNION ALL
        SELECT affair_id, id, row_id, ln, 4 + k, CASE k WHEN 1 THEN '| Code | Libellé | Quantité mensuelle | Prix unitaire | Loyer mensuel HT |'
          WHEN 2 THEN '| --- | --- | --- | --- | --- |' ELSE '| 04317 | ' || p_name || ' | ' || count || ' | ' || count || ',00 € | ' || money || ' € |' END
        FROM money_v, (VALUES (1), (2), (3)) AS three(k) WHERE sheet = 0
        UNION ALL
        SELECT affair_id, id, row_id, ln, 7 + k, CASE k WHEN 1 THEN 'Pricing mensuel volumes'
          WHEN 2 THEN '| Famille | Nombre de lignes par an | ' || (2015 + ln) || ' S1 | ' || (2015 + ln) || ' S2 |' WHEN 3 THEN '|---|---|---|---|'
          ELSE '| ' || p_name || ' | ' || count || ' | ' || money || ' € | ' || count || ',00 € HT |' END
        FROM money_v, (VALUES (1), (2), (3), (4)) AS four(k) WHERE sheet = 1
        UNION ALL
        SELECT affair_id, id, row_id, ln, 12, '| 04311 | ' || p_name || ' | ' || count || ' | ' || money || ' € HT |' FROM money_v WHERE sheet = 2 AND rf = 'R'""",
    "numbered_v": """
        SELECT *, CAST(row_number() OVER (PARTITION BY row_id ORDER BY part) - 1 AS INT) AS line_no FROM text_lines_v""",
    "amounts_v": """
        SELECT n.affair_id, n.id, n.line_no, n.part, n.ln, 0 AS amount_no, m.p_name AS label, m.cents / 100.0 AS amount, 'EUR' AS currency, 'HT' AS tax_basis,
          CASE n.ln % 3 WHEN 0 THEN 'Mensuelle' WHEN 1 THEN 'Annuelle' ELSE 'unknown' END AS cadence, false AS is_recap,
          NULL::VARCHAR AS code, NULL::DOUBLE AS quantity, NULL::VARCHAR AS counted, NULL::DOUBLE AS unit, false AS period
        FROM numbered_v n JOIN money_v m USING (row_id) WHERE part = 0
        UNION ALL
        SELECT n.affair_id, n.id, n.line_no, n.part, n.ln, k, 'Licence', CASE k WHEN 0 THEN m.units ELSE m.cents / 100.0 END, 'EUR',
          CASE k WHEN 1 THEN 'TTC' END, 'unknown', false, NULL, NULL, NULL, NULL, false
        FROM numbered_v n JOIN money_v m USING (row_id), (VALUES (0), (1)) AS two(k) WHERE part = 1
        UNION ALL
        SELECT n.affair_id, n.id, n.line_no, n.part, n.ln, 0, CASE n.ln WHEN 1 THEN 'Total' WHEN 3 THEN 'Total abonnement, montant forfaitaire mensuel total de'
            WHEN 4 THEN 'REMISE COMMERCIALE' ELSE 'Utilisateur supplémentaire' END,
          CASE n.ln WHEN 4 THEN -m.cents / 100.0 WHEN 5 THEN 10.0 ELSE m.cents / 100.0 END, 'EUR',
          CASE WHEN n.ln IN (1, 4) THEN 'HT' END, CASE WHEN n.ln IN (3, 5) THEN 'Mensuelle' ELSE 'unknown' END, n.ln = 1, NULL, NULL, NULL, NULL, false
        FROM numbered_v n JOIN money_v m USING (row_id) WHERE part = 2 AND n.ln IN (1, 3, 4, 5)
        UNION ALL
        SELECT n.affair_id, n.id, n.line_no, n.part, n.ln, 0, 'Option étendue', m.cents / 100.0, 'EUR', 'HT', 'Mensuelle', false, NULL, NULL, NULL, NULL, false
        FROM numbered_v n JOIN money_v m USING (row_id) WHERE part = 4
        UNION ALL
        SELECT n.affair_id, n.id, n.line_no, n.part, n.ln, 0, m.p_name, m.cents / 100.0, 'EUR', 'HT', CASE part WHEN 7 THEN 'Mensuelle' ELSE 'unknown' END, false,
          CASE part WHEN 7 THEN '04317' ELSE '04311' END, m.count, CASE part WHEN 7 THEN 'Mensuelle' END, CASE part WHEN 7 THEN m.count END, false
        FROM numbered_v n JOIN money_v m USING (row_id) WHERE part IN (7, 12)
        UNION ALL
        SELECT n.affair_id, n.id, n.line_no, n.part, n.ln, k, 'Abonnement volume ' || m.p_name || ' — ' || (2015 + n.ln) || ' S' || (k + 1),
          CASE k WHEN 0 THEN m.cents / 100.0 ELSE m.count END, 'EUR', CASE k WHEN 1 THEN 'HT' END, 'Mensuelle', false, NULL, m.count, 'Annuelle', NULL, true
        FROM numbered_v n JOIN money_v m USING (row_id), (VALUES (0), (1)) AS two(k) WHERE part = 11""",
    "gate_v": """
        SELECT affair_id, bool_or(one_shot_service) AND NOT bool_and(one_shot_service)
          AND bool_or(is_volume_product) AND NOT bool_and(is_volume_product) AS open
        FROM products_v GROUP BY affair_id""",
    "contracts_v": """
        SELECT *, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS signed FROM orders""",
}
NEEDS = {
    "docs_v": ["paths_v"], "matched_v": ["docs_v", "affairs_v"], "seq_v": ["products_v"], "consolidated_v": ["products_v"],
    "money_v": ["items_v"], "text_lines_v": ["money_v"], "numbered_v": ["text_lines_v"], "amounts_v": ["numbered_v"],
    "gate_v": ["products_v"],
}


def _with(names: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    # computed once per query, however often it is read
    head = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in ordered)
    body = body.strip()
    if not ordered:
        return body
    return f"WITH {head}{body}" if body.startswith(",") else f"WITH {head}\n{body}"


def twin(name: str, uses: list[str], body: str) -> None:
    ORACLE[name] = _with(uses, body)


# --- paths, ids, listing -----------------------------------------------------

twin("parse_path", ["paths_v"], r"""
, given AS (SELECT path FROM paths_v UNION ALL SELECT url FROM pages),
cut AS (SELECT path, list_filter(regexp_split_to_array(trim(path), '[\\/]+'), lambda p: p <> '') AS p FROM given)
SELECT path, len(p) >= 3 AS path_ok,
  CASE WHEN len(p) >= 3 THEN p[1] END AS letter, CASE WHEN len(p) >= 3 THEN p[2] END AS company,
  CASE WHEN len(p) > 3 THEN array_to_string(p[3:len(p) - 1], '/') END AS affair,
  CASE WHEN len(p) >= 3 THEN p[len(p)] END AS filename,
  CASE WHEN len(p) >= 3 THEN p[1] || '/' || p[2] END AS company_key,
  CASE WHEN len(p) > 3 THEN array_to_string(p[1:len(p) - 1], '/') WHEN len(p) = 3 THEN p[1] || '/' || p[2] || '/root' END AS affair_key
FROM cut""")

twin("slug", [], r"""
SELECT page_id, trim(left(regexp_replace(regexp_replace(trim(url), '[/\\?#]', '_', 'g'), '[^A-Za-z0-9._-]+', '-', 'g'), 200), '-_.') AS slug
FROM pages""")

twin("affairs_list", [], """
SELECT doc_id, source AS affair FROM documents UNION ALL SELECT doc_id, lang FROM documents""")

twin("select_affair", ["paths_v"], "SELECT path FROM paths_v WHERE source LIKE 'src1%'")

twin("build_documents", ["paths_v"], """
SELECT replace(path, '/', '_') AS id, string_split(path, '/')[4] AS title, md5(text) AS content, path AS file_path,
  CASE WHEN lang = 'en' THEN 'unknown' ELSE lang END AS language, CAST(1 + n_chars // 1800 AS INT) AS page_count,
  length(text) AS n_chars, 'prebuilt-layout' AS analyse_doc_model, upper(left(lang, 1)) AS company_letter, 'co_' || lang AS company_name, source AS company_affair,
  upper(left(lang, 1)) || '/co_' || lang AS company_name_path, upper(left(lang, 1)) || '/co_' || lang || '/' || source AS company_affair_path,
  lower(replace(path, '/', '_')) AS id_lc, true AS path_ok
FROM paths_v""")

twin("page_cost", [], """
SELECT lang AS language, count(*) AS n_docs, avg(1 + n_chars // 1800) AS mean_pages,
  (CAST(8.626 AS DOUBLE) / 1000) * avg(1 + n_chars // 1800) AS price_single,
  (CAST(8.626 AS DOUBLE) / 1000) * 2000 * avg(1 + n_chars // 1800) AS price_total
FROM documents GROUP BY lang""")

twin("id_collisions", [], r"""
WITH visited AS (SELECT url, trim(left(regexp_replace(regexp_replace(trim(url), '[/\\?#]', '_', 'g'), '[^A-Za-z0-9._-]+', '-', 'g'), 200), '-_.') AS id FROM pages)
SELECT id, count(DISTINCT url) AS n_paths FROM visited GROUP BY id HAVING count(DISTINCT url) > 1""")

# --- stores --------------------------------------------------------------------

twin("document_count", [], "SELECT count(*) AS n_documents FROM documents")

twin("fetch_by_ids", [], "SELECT doc_id AS id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")

twin("latest_per_key", [], """
SELECT user_id, event_id, event_type, value FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events l WHERE l.user_id = e.user_id AND (l.ts > e.ts OR (l.ts = e.ts AND l.event_id > e.event_id)))""")

twin("upsert_documents", [], """
SELECT 'd' || doc_id AS id, CASE WHEN quality IS NULL THEN md5(text) ELSE md5(text || quality) END AS content,
  CAST(coalesce(2 + quality, 1) AS INT) AS version
FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL
SELECT 'p' || page_id, md5(html), 2 FROM pages""")

# --- documents of an affair ----------------------------------------------------

twin("docs_for_affair", ["docs_v"], "SELECT id, CAST(page_count AS INT) AS page_count FROM docs_v WHERE id ILIKE '%src1%' AND lower_pdf")
twin("exclude_kinds", ["docs_v"], "SELECT id FROM docs_v WHERE kind <> 5")
twin("excluded_ids", ["docs_v"], "SELECT id FROM docs_v WHERE kind = 5")
twin("match_affairs", ["docs_v", "affairs_v"], """
SELECT a.affair_id, d.id FROM docs_v d, affairs_v a WHERE d.lower_pdf AND position(a.affair_id IN lower(d.id)) > 0""")

twin("classify_documents", ["docs_v"], """
SELECT id, CASE kind WHEN 0 THEN 'CG' WHEN 1 THEN 'CP' WHEN 3 THEN 'CP' WHEN 5 THEN 'CP' ELSE 'AV' END AS doc_class FROM docs_v""")

twin("split_report", ["matched_v"], """
SELECT affair_id, count(*) AS n_docs, count(*) FILTER (kind = 0) AS n_cg, count(*) FILTER (kind IN (1, 3)) AS n_cp,
  count(*) FILTER (kind IN (2, 4)) AS n_av, CAST(0 AS BIGINT) AS n_overlap, CAST(0 AS BIGINT) AS n_orphan,
  CAST(coalesce(sum(length(content)) FILTER (kind = 0), 0) AS BIGINT) AS cg_chars,
  CAST(coalesce(sum(length(content)) FILTER (kind IN (1, 3)), 0) AS BIGINT) AS cp_chars,
  CAST(coalesce(sum(length(content)) FILTER (kind IN (2, 4)), 0) AS BIGINT) AS av_chars,
  CASE WHEN count(*) FILTER (kind IN (1, 3)) = 0 THEN 'no CP' END AS reason,
  count(*) FILTER (kind IN (1, 3)) > 0 AS ok
FROM matched_v GROUP BY affair_id""")

JOINED = """
, joined AS (SELECT affair_id, count(*) FILTER (kind = 0) AS n_cg, count(*) FILTER (kind IN (1, 3)) AS n_cp,
    coalesce(string_agg(content, chr(10) ORDER BY id) FILTER (kind = 0), '') AS cg,
    coalesce(string_agg(content, chr(10) ORDER BY id) FILTER (kind IN (1, 3)), '') AS cp
  FROM matched_v WHERE kind IN (0, 1, 3) GROUP BY affair_id)"""

twin("concat_contents", ["matched_v"], JOINED + """
SELECT affair_id, CAST(0 AS INT) AS part, n_cg, n_cp, length(cg) AS cg_chars, md5(cg) AS cg_md5, length(cp) AS cp_chars, md5(cp) AS cp_md5 FROM joined""")

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"
twin("cgcp_requests", ["matched_v"], JOINED + f"""
, chats AS (SELECT affair_id, 'system: Return every priced product.' || chr(10) || 'user: DOCUMENT CONTENT:' || chr(10) || chr(10)
    || '=== DOC: CADRE — type=cadre ===' || chr(10) || trim(cg, {BLANK}) || chr(10) || chr(10)
    || '=== DOC: SOUSCRIPTION — type=souscription ===' || chr(10) || trim(cp, {BLANK})
    || chr(10) || chr(10) || 'TASK:' || chr(10) || 'List the products of the contract.' AS chat FROM joined)
SELECT affair_id || '|CGCP' AS request_id, affair_id, 'CGCP' AS doc_class, length(chat) AS chars, md5(chat) AS chat_md5 FROM chats""")

twin("avenant_requests", ["matched_v"], """
, chats AS (SELECT affair_id, id, 'system: Return every priced product.' || chr(10) || 'user: DOCUMENT CONTENT:' || chr(10) || chr(10)
    || '=== DOC: AVENANT — type=avenant ===' || chr(10) || content
    || chr(10) || chr(10) || 'TASK:' || chr(10) || 'List the products of each amendment.' AS chat FROM matched_v WHERE kind IN (2, 4))
SELECT affair_id || '|AV|' || id AS request_id, affair_id, 'AV' AS doc_class, length(chat) AS chars, md5(chat) AS chat_md5 FROM chats""")

# --- answers ---------------------------------------------------------------------

twin("attach_responses", ["answers_v"], """
SELECT CAST(c_custkey AS VARCHAR) AS request_id,
  CASE WHEN event_id IS NULL THEN NULL WHEN event_id % 97 = 0 THEN 'length' ELSE 'tool_calls' END AS finish_reason, prompt_tokens, completion_tokens
FROM customer LEFT JOIN answers_v ON event_id = c_custkey""")

twin("token_cost", ["answers_v"], """
SELECT affair_id, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
  count(*) FILTER (event_id % 97 = 0) AS n_truncated,
  sum(prompt_tokens) / CAST(1e6 AS DOUBLE) * CAST(1.73 AS DOUBLE) + sum(completion_tokens) / CAST(1e6 AS DOUBLE) * CAST(6.91 AS DOUBLE) AS cost_eur,
  2000 * (sum(prompt_tokens) / CAST(1e6 AS DOUBLE) * CAST(1.73 AS DOUBLE) + sum(completion_tokens) / CAST(1e6 AS DOUBLE) * CAST(6.91 AS DOUBLE)) AS cost_all_eur
FROM answers_v GROUP BY affair_id""")

twin("response_status", ["answers_v"], "SELECT request_id, status, CASE WHEN status = 'ok' THEN 1 ELSE 0 END AS n_products, event_id % 97 = 0 AS hit_limit FROM answers_v")

twin("parse_responses", ["answers_v"], """
SELECT request_id, affair_id, CAST(0 AS INT) AS pos, event_type AS product_name, CASE WHEN event_id % 83 <> 0 THEN value END AS price_unitaire,
  CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS loyer
FROM answers_v WHERE status = 'ok'""")

NESTED = """
WITH said AS (SELECT CAST(event_id AS VARCHAR) AS request_id, * FROM events WHERE event_type <> 'error' AND event_id % 97 <> 0),
fields AS (
  SELECT request_id, CAST(0 AS INT) AS pos, 'product_name' AS name, event_type AS value FROM said
  UNION ALL SELECT request_id, 0, 'price.unit', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) FROM said
  UNION ALL SELECT request_id, 0, 'price.per.period', 'Mensuelle' FROM said
  UNION ALL SELECT request_id, 0, 'price.per.count', NULL FROM said
  UNION ALL SELECT request_id, 0, 'meta.k', regexp_extract(props, '"k": *([0-9]+)', 1) FROM said
  UNION ALL SELECT request_id, 0, 'tags', '["a",{"b":1}]' FROM said
  UNION ALL SELECT request_id, 0, 'none', '{}' FROM said
  UNION ALL SELECT request_id, 0, 'remise.rate', '0.5' FROM said WHERE event_id % 89 = 0
  UNION ALL SELECT request_id, 1, 'product_name', 'second' FROM said)
"""
twin("nested_fields", [], NESTED + "SELECT request_id, pos, name, value FROM fields")
twin("nested_schema", [], NESTED + "SELECT name, count(*) AS n_products, count(value) AS n_values FROM fields GROUP BY name")

twin("unknown_keys", ["answers_v"], "SELECT request_id, CAST(0 AS INT) AS pos, 'remise' AS key FROM answers_v WHERE event_id % 89 = 0 AND status = 'ok'")

twin("coercion_losses", ["answers_v"], """
SELECT request_id, CAST(0 AS INT) AS pos, 'price_unitaire' AS "column", '1 200,50' AS given FROM answers_v WHERE status = 'ok' AND event_id % 83 = 0""")

twin("rent_status", ["answers_v"], """
SELECT request_id, CAST(0 AS INT) AS pos, CAST(NULL AS VARCHAR) AS loyer_facturation_status,
  CASE WHEN event_id % 79 = 0 THEN 'unknown' END AS loyer_annuele_status
FROM answers_v WHERE status = 'ok'""")

GIVEN = {
    "usage_notes": "repeat('ab', notes_words)", "confidence_price": "quantity / 25",
    **{c: f"CAST(NULL AS BOOLEAN)" for c in ("bon_de_commande",)},
    **{c: "CAST(NULL AS DOUBLE)" for c in ("loyer_facturation", "loyer_annuele", "reval_rate_per")},
}
HELD = {
    "company_name", "numero_de_contrat", "signature_date_cp", "signature_date_av", "avenant_number", "product_code", "product_name",
    "duree_de_service", "duree_de_service_notes", "reconduction_tacite", "term_mode", "billing_frequency", "payment_methods",
    "price_unitaire", "quantity", "quantity_periodicity", "is_volume_product", "loyer", "devise_de_facturation", "loyer_periodicity",
    "one_shot_service", "tax_basis", "is_included", "usage_overconsumption_price", "reval_method", "evidence_price",
    "evidence_usage", "evidence_revalorization", "evidence_billing", "evidence_dates", "evidence_avenant", "evidence_contract_errors",
    "confidence_usage", "confidence_revalorization", "confidence_billing", "confidence_dates", "confidence_company", "confidence_avenant",
}
twin("rectify_products", ["products_v"], "SELECT affair_id, request_id, pos, " + ", ".join(
    c if c in HELD else f"{GIVEN.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in PRODUCT_COLUMNS
) + " FROM products_v")

twin("normalize_missing", ["products_v"], "SELECT request_id, pos, signature_date_cp, product_code FROM products_v")

twin("render_missing", ["products_v"], """
SELECT request_id, CAST(pos AS VARCHAR) AS pos, coalesce(signature_date_cp, 'null') AS signature_date_cp,
  coalesce(signature_date_av, 'null') AS signature_date_av, coalesce(CAST(avenant_number AS VARCHAR), 'null') AS avenant_number,
  coalesce(product_code, 'null') AS product_code, CASE WHEN one_shot_service THEN 'true' ELSE 'false' END AS one_shot_service,
  coalesce(reval_method, 'null') AS reval_method
FROM products_v""")

twin("enum_violations", ["products_v"], """
SELECT affair_id, request_id, pos, 'devise_de_facturation' AS "column", devise_de_facturation AS value FROM products_v WHERE devise_de_facturation = 'XAF'
UNION ALL SELECT affair_id, request_id, pos, 'term_mode', term_mode FROM products_v WHERE term_mode = 'Annuel'
UNION ALL SELECT affair_id, request_id, pos, 'loyer_periodicity', loyer_periodicity FROM products_v WHERE loyer_periodicity = 'Semestrielle'
UNION ALL SELECT affair_id, request_id, pos, 'billing_frequency', billing_frequency FROM products_v WHERE billing_frequency = 'Semestrielle'
UNION ALL SELECT affair_id, request_id, pos, 'reval_method', reval_method FROM products_v WHERE reval_method = 'Syntec'
UNION ALL SELECT affair_id, request_id, pos, 'payment_methods', 'bitcoin' FROM products_v WHERE payment_methods = 'virement,bitcoin'""")

twin("format_violations", ["products_v"], """
SELECT affair_id, request_id, pos, 'numero_de_contrat' AS "column", CAST(length(numero_de_contrat) AS DOUBLE) AS measure FROM products_v WHERE contains(numero_de_contrat, '/')
UNION ALL SELECT affair_id, request_id, pos, 'confidence_price', quantity FROM products_v WHERE quantity > 25
UNION ALL SELECT affair_id, request_id, pos, 'usage_notes', CAST(2 * notes_words AS DOUBLE) FROM products_v WHERE 2 * notes_words > 160
UNION ALL SELECT affair_id, request_id, pos, 'evidence_contract_errors', CAST(error_chars AS DOUBLE) FROM products_v
  WHERE evidence_contract_errors IS NOT NULL AND error_chars > 140""")

# --- consolidation -----------------------------------------------------------------

twin("consolidate", ["consolidated_v"], """
SELECT affair_id, request_id, pos, is_av, CAST(signed AS VARCHAR) AS signature_date, seq FROM consolidated_v""")
twin("sequence_products", ["seq_v"], "SELECT affair_id, request_id, pos, seq FROM seq_v")
twin("avenant_coverage", ["products_v"], """
SELECT affair_id, count(DISTINCT request_id) AS n_received, count(DISTINCT avenant_number) AS n_numbers FROM products_v WHERE is_av GROUP BY affair_id""")

WORDS = r"list_distinct(list_filter(regexp_split_to_array({c}, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''))"
BEST = f"""
, known AS (SELECT DISTINCT affair_id, lower(product_name) AS cp_desc FROM products_v WHERE NOT is_av),
wanted AS (SELECT DISTINCT affair_id, lower(product_name) AS av_desc FROM products_v WHERE is_av@),
known_words AS (SELECT DISTINCT affair_id, unnest({WORDS.format(c='cp_desc')}) AS word FROM known),
wanted_words AS (SELECT affair_id, av_desc, unnest({WORDS.format(c='av_desc')}) AS word FROM wanted),
spelled AS (SELECT w.affair_id, w.word, k.word AS near FROM (SELECT DISTINCT affair_id, word FROM wanted_words) w JOIN known_words k USING (affair_id)
  WHERE levenshtein(w.word, k.word) <= CASE WHEN regexp_matches(w.word || k.word, '[0-9]') THEN 0
    WHEN least(length(w.word), length(k.word)) >= 8 THEN 2 WHEN least(length(w.word), length(k.word)) >= 4 THEN 1 ELSE 0 END
  QUALIFY row_number() OVER (PARTITION BY w.affair_id, w.word ORDER BY levenshtein(w.word, k.word), k.word) = 1),
told AS (SELECT affair_id, av_desc, list_distinct(list(coalesce(near, word))) AS words
  FROM wanted_words LEFT JOIN spelled USING (affair_id, word) GROUP BY affair_id, av_desc),
near AS (SELECT affair_id, av_desc, cp_desc, CASE WHEN av_desc = cp_desc THEN 1.0::DOUBLE ELSE
    len(list_intersect(words, {WORDS.format(c='cp_desc')})) / len(list_distinct(list_concat(words, {WORDS.format(c='cp_desc')})))::DOUBLE END AS likeness
  FROM known JOIN wanted USING (affair_id) JOIN told USING (affair_id, av_desc)),
best AS (SELECT * FROM near WHERE likeness >= 0.3::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY affair_id, av_desc ORDER BY av_desc = cp_desc DESC, likeness DESC, cp_desc) = 1)"""

twin("match_by_description", ["products_v"], BEST.replace("@", "") + """
SELECT affair_id, av_desc, cp_desc, likeness FROM best""")

twin("amendment_delta", ["seq_v"], BEST.replace("@", " AND product_code IS NULL") + """
, desc_key AS (SELECT affair_id, lower(product_name) AS cp_desc, coalesce(min(product_code), lower(product_name)) AS cp_key
  FROM products_v WHERE NOT is_av GROUP BY affair_id, lower(product_name)),
keyed AS (SELECT s.*, coalesce(product_code, CASE WHEN is_av THEN ka.cp_key ELSE kc.cp_key END, lower(product_name)) AS product_key,
    loyer * 12 / CASE loyer_periodicity WHEN 'Mensuelle' THEN 1 WHEN 'Trimestrielle' THEN 3 WHEN 'Semestrielle' THEN 6 WHEN 'Annuelle' THEN 12 END AS rent
  FROM seq_v s LEFT JOIN best b ON s.product_code IS NULL AND s.is_av AND b.affair_id = s.affair_id AND b.av_desc = lower(s.product_name)
  LEFT JOIN desc_key ka ON ka.affair_id = b.affair_id AND ka.cp_desc = b.cp_desc
  LEFT JOIN desc_key kc ON NOT s.is_av AND kc.affair_id = s.affair_id AND kc.cp_desc = lower(s.product_name)),
back AS (SELECT *, lag(rent) OVER w AS old_rent, lag(price_unitaire) OVER w AS old_price, lag(seq) OVER w AS old_seq FROM keyed
  WINDOW w AS (PARTITION BY affair_id, product_key ORDER BY seq)),
based AS (SELECT *, CASE WHEN rent IS NOT NULL AND old_rent IS NOT NULL THEN 'annual_rent'
  WHEN price_unitaire IS NOT NULL AND old_price IS NOT NULL THEN 'unit_price' END AS basis FROM back WHERE is_av AND old_seq IS NOT NULL),
costs AS (SELECT *, CASE basis WHEN 'annual_rent' THEN old_rent WHEN 'unit_price' THEN old_price END AS old_cost,
  CASE basis WHEN 'annual_rent' THEN rent WHEN 'unit_price' THEN price_unitaire END AS new_cost FROM based)
SELECT affair_id, product_key, seq, avenant_number, basis, old_cost, new_cost, new_cost - old_cost AS delta,
  CASE WHEN basis IS NULL THEN CASE WHEN old_rent IS NULL AND old_price IS NULL THEN 'no old cost'
    WHEN rent IS NULL AND price_unitaire IS NULL THEN 'no new cost' ELSE 'unlike costs' END END AS reason
FROM costs""")

twin("resolve_terms", [], """
WITH general AS (SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN -o_orderkey ELSE o_orderkey END AS gk, c_custkey, c_mktsegment, o_orderpriority AS gp
  FROM orders JOIN customer ON o_custkey = c_custkey),
special AS (SELECT o_orderkey AS pk, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
sides AS (SELECT coalesce(gk, pk) AS affair_id,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'USD' WHEN 'MACHINERY' THEN NULL ELSE CASE WHEN c_custkey IS NOT NULL THEN 'EUR' END END AS g1,
  CASE WHEN gp <> '3-MEDIUM' THEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') END AS g2,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Annuelle' WHEN c_custkey IS NOT NULL THEN 'Mensuelle' END AS g3,
  CASE WHEN st <> 'O' THEN 'GBP' END AS p1, CASE WHEN st <> 'O' THEN st = 'P' END AS p2, CASE WHEN pr <> '5-LOW' THEN 'Trimestrielle' END AS p3
  FROM general FULL JOIN special ON gk = pk)
SELECT affair_id, coalesce(p1, g1) AS devise_de_facturation, CASE WHEN p1 IS NOT NULL THEN 'CP' WHEN g1 IS NOT NULL THEN 'CG' END AS devise_de_facturation_source,
  coalesce(p2, g2) AS reconduction_tacite, CASE WHEN p2 IS NOT NULL THEN 'CP' WHEN g2 IS NOT NULL THEN 'CG' END AS reconduction_tacite_source,
  coalesce(p3, g3) AS billing_frequency, CASE WHEN p3 IS NOT NULL THEN 'CP' WHEN g3 IS NOT NULL THEN 'CG' END AS billing_frequency_source
FROM sides""")

twin("pack_results", ["consolidated_v"], """
SELECT affair_id AS id, CAST(0 AS INT) AS part, CAST(1 AS BIGINT) AS first_seq, CAST(count(*) AS INT) AS n_rows, string_agg(product_name, '|' ORDER BY seq) AS names,
  string_agg(coalesce(product_code, 'null'), '|' ORDER BY seq) AS codes
FROM consolidated_v GROUP BY affair_id""")
twin("unpack_results", ["consolidated_v"], """
SELECT affair_id, seq, product_name, product_code, loyer, avenant_number, one_shot_service FROM consolidated_v""")
twin("upsert_results", ["products_v"], """
SELECT affair_id AS id, CAST(0 AS INT) AS part, CAST(count(*) AS INT) AS n_rows FROM products_v
WHERE NOT is_av OR affair_id IN (SELECT affair_id FROM products_v WHERE NOT is_av) GROUP BY affair_id
UNION ALL
SELECT affair_id, 0, CAST(count(*) AS INT) FROM products_v WHERE affair_id NOT IN (SELECT affair_id FROM products_v WHERE NOT is_av) GROUP BY affair_id""")

# --- prices ----------------------------------------------------------------------------

CLEANED = """
SELECT affair_id, request_id, pos, CASE WHEN {open} AND one_shot_service AND price_unitaire IS NULL THEN loyer ELSE price_unitaire END AS price_unitaire,
  CASE WHEN {clear} THEN NULL ELSE loyer END AS loyer, CASE WHEN {clear} THEN NULL ELSE billing_frequency END AS billing_frequency,
  CASE WHEN {clear} THEN NULL ELSE loyer_periodicity END AS loyer_periodicity
FROM products_v {join}"""
twin("clean_rents", ["gate_v"], CLEANED.format(open="open", clear="open AND one_shot_service AND NOT is_volume_product", join="JOIN gate_v USING (affair_id)"))
twin("clean_rents_unsafe", ["products_v"], CLEANED.format(open="true", clear="one_shot_service AND NOT is_volume_product", join=""))
twin("clean_rents_moved", ["gate_v"], """
SELECT affair_id, count(*) FILTER (open AND one_shot_service AND price_unitaire IS NULL AND loyer IS NOT NULL) AS n_moved
FROM products_v JOIN gate_v USING (affair_id) GROUP BY affair_id""")

MONTHS = "CASE {c} WHEN 'Mensuelle' THEN 1 WHEN 'Trimestrielle' THEN 3 WHEN 'Semestrielle' THEN 6 WHEN 'Annuelle' THEN 12 END"
twin("derive_rents", ["products_v"], f"""
, m AS (SELECT *, {MONTHS.format(c='loyer_periodicity')} AS lm, {MONTHS.format(c='billing_frequency')} AS bm FROM products_v)
SELECT request_id, pos, CASE WHEN NOT one_shot_service THEN loyer * bm / lm END AS loyer_facturation,
  CASE WHEN NOT one_shot_service THEN CASE WHEN lm IS NULL OR bm IS NULL THEN 'unknown' ELSE 'ok' END END AS loyer_facturation_status,
  CASE WHEN NOT one_shot_service THEN loyer * 12 / lm END AS loyer_annuele,
  CASE WHEN NOT one_shot_service THEN CASE WHEN lm IS NULL THEN 'unknown' ELSE 'ok' END END AS loyer_annuele_status
FROM m""")
twin("volume_unit_price", ["products_v"], f"""
, m AS (SELECT *, {MONTHS.format(c='loyer_periodicity')} AS lm, {MONTHS.format(c='quantity_periodicity')} AS qm FROM products_v)
SELECT request_id, pos, CASE WHEN is_volume_product THEN (loyer * qm) / (lm * quantity) END AS volume_unit_price FROM m""")
twin("contract_end", ["products_v"], """
, e AS (SELECT *, one_shot_service OR is_included AS none,
    CAST(signed + to_months(CAST(duree_mois + CASE WHEN duree_de_service_notes IS NULL THEN 0 ELSE 12 - month(signed) END AS INT)) AS DATE) AS done FROM products_v)
SELECT request_id, pos, CASE WHEN none THEN NULL WHEN reconduction_tacite THEN '2099-12-31' ELSE CAST(done AS VARCHAR) END AS date_end_calc,
  CASE WHEN none THEN NULL WHEN reconduction_tacite OR done IS NOT NULL THEN 'ok' ELSE 'unknown' END AS date_end_status
FROM e""")
twin("apply_null_rules", ["products_v"], """
SELECT request_id, pos, CASE WHEN NOT is_included THEN price_unitaire END AS price_unitaire, CASE WHEN NOT one_shot_service THEN loyer END AS loyer,
  CASE WHEN NOT one_shot_service THEN billing_frequency END AS billing_frequency,
  CASE WHEN NOT one_shot_service AND NOT is_included THEN loyer_periodicity END AS loyer_periodicity,
  CASE WHEN NOT one_shot_service AND NOT is_included THEN term_mode END AS term_mode,
  CASE WHEN NOT one_shot_service AND NOT is_included THEN reval_method END AS reval_method,
  is_volume_product AND NOT one_shot_service AS is_volume_product,
  CASE WHEN is_volume_product THEN usage_overconsumption_price END AS usage_overconsumption_price
FROM products_v""")
twin("null_rule_violations", ["products_v"], "\nUNION ALL\n".join(
    f"SELECT affair_id, request_id, pos, '{rule}' AS rule, '{c}' AS \"column\" FROM products_v WHERE {cond} AND {c} IS NOT NULL"
    for rule, cond, columns in [
        ("included", "is_included", ["price_unitaire"]),
        ("one_shot", "one_shot_service", ["loyer", "billing_frequency", "loyer_periodicity"]),
        ("one_shot", "one_shot_service AND is_volume_product", ["is_volume_product"]),
        ("one_shot_or_included", "(one_shot_service OR is_included)", ["term_mode", "reval_method", "loyer_periodicity"]),
        ("not_volume", "NOT is_volume_product", ["usage_overconsumption_price"]),
    ]
    for c in columns
))

# --- values in texts ---------------------------------------------------------------------

twin("parse_dates", [], "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders")
twin("parse_numbers", [], """
SELECT l_orderkey, l_linenumber, l_extendedprice,
  CASE l_linenumber WHEN 1 THEN l_extendedprice WHEN 4 THEN -l_extendedprice WHEN 5 THEN l_quantity * 100 END AS number
FROM lineitem""")
twin("line_flags", ["numbered_v"], """
SELECT id, line_no, part = 1 OR (part = 2 AND ln = 7) AS is_one_time, part = 2 AND ln IN (2, 7) AS is_included,
  (part = 2 AND ln IN (5, 6)) OR part IN (8, 9) AS is_volume, (part = 2 AND ln IN (5, 6)) OR part = 9 AS is_overconsumption
FROM numbered_v""")
twin("priced_lines", ["amounts_v"], """
SELECT affair_id, id, line_no, amount_no, label, CAST(amount AS DOUBLE) AS amount, currency, tax_basis, cadence, is_recap,
  code AS product_code, quantity, counted AS quantity_periodicity, unit AS unit_price FROM amounts_v""")
twin("drop_recaps", ["numbered_v"], "SELECT affair_id, id, line_no, md5(line) AS line_md5 FROM numbered_v WHERE NOT (part = 2 AND ln = 1)")
twin("rule_extract", ["amounts_v"], """
, found AS (
  SELECT affair_id, id, line_no, amount_no, label, CAST(amount AS DOUBLE) AS amount, currency, tax_basis, cadence, false AS free,
    part = 1 AS once, period OR (part = 2 AND ln = 5) AS volume, code, quantity, counted, unit FROM amounts_v WHERE NOT is_recap
  UNION ALL
  SELECT affair_id, id, line_no, 0, line, NULL, NULL, NULL, 'unknown', true, false, false, NULL, NULL, NULL, NULL FROM numbered_v WHERE part = 2 AND ln IN (2, 7))
SELECT affair_id, id, line_no, amount_no, label AS product_name, free AS is_included, once AS one_shot_service, volume AS is_volume_product,
  code AS product_code, quantity, counted AS quantity_periodicity,
  CASE WHEN once THEN amount ELSE unit END AS price_unitaire, CASE WHEN NOT once AND NOT free THEN amount END AS loyer,
  CASE WHEN NOT once AND NOT free THEN cadence END AS loyer_periodicity, currency AS devise_de_facturation, tax_basis
FROM found""")
twin("volume_period", [], """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'Abonnement volume ' || p_type || ' — ' || year(l_shipdate) || ' '
    || CASE WHEN month(l_shipdate) <= 6 THEN 'S1' ELSE 'S2' END ELSE p_name END AS product_name,
  CASE WHEN l_linestatus = 'O' THEN p_type END AS family, CASE WHEN l_linestatus = 'O' THEN CAST(year(l_shipdate) AS INT) END AS year,
  CASE WHEN l_linestatus = 'O' THEN CASE WHEN month(l_shipdate) <= 6 THEN 'S1' ELSE 'S2' END END AS half
FROM lineitem JOIN part ON l_partkey = p_partkey""")
twin("service_start", [], """
SELECT l_orderkey, l_linenumber, strftime(CASE WHEN l_linenumber % 3 = 1 OR (l_linenumber % 3 = 0 AND l_linenumber > 4) THEN l_shipdate
  WHEN l_linenumber % 3 = 0 THEN o_orderdate END, '%Y-%m-%d') AS service_start
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
twin("overconsumption", [], """
SELECT l_orderkey, l_linenumber, l_quantity,
  CASE l_linenumber % 4 WHEN 0 THEN CAST(l_quantity AS INT) || '.05'
    WHEN 1 THEN 'unité d’œuvre surcotée de ' || CAST(l_quantity AS INT) || '% vs palier, facturée par semestre, terme échu' END AS price,
  CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_quantity AS INT) || '.05' AS DOUBLE) END AS unit_price,
  CASE l_linenumber % 4 WHEN 0 THEN 'Mensuelle' WHEN 1 THEN 'Semestrielle' END AS periodicity,
  CASE WHEN l_linenumber % 4 = 1 THEN 'Échu' END AS term_mode
FROM lineitem""")
twin("split_duration", [], """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'indeterminé' WHEN o_orderkey % 3 < 2 THEN CAST(12 * (1 + o_custkey % 5) AS VARCHAR) END AS duree,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 3 < 2 THEN CAST(12 * (1 + o_custkey % 5) AS DOUBLE) END AS duree_mois,
  CASE o_orderkey % 3 WHEN 0 THEN '+ prorata de la période en cours' WHEN 2 THEN 'durée du projet' END AS notes
FROM orders""")
twin("payment_methods", ["contracts_v"], """
SELECT id, ['virement,cheque', 'prelevement', 'other,portal'][CAST(o_custkey % 3 + 1 AS INT)] AS methods,
  CASE WHEN o_custkey % 3 = 0 THEN 'A 45 jours date de facture' END AS terms
FROM contracts_v""")
twin("contract_terms", ["contracts_v"], """
SELECT id, strftime(signed, '%Y%m') || '00-' || o_custkey AS numero_de_contrat, ['EUR', 'USD', 'GBP'][CAST(o_custkey % 3 + 1 AS INT)] AS devise_de_facturation,
  CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS reconduction_tacite, CASE o_custkey % 4 WHEN 0 THEN 'HT' WHEN 1 THEN 'TTC' END AS tax_basis,
  o_orderpriority = '1-URGENT' AS bon_de_commande,
  CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(signed, '%Y%m') || ' ' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS bon_de_commande_code,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'PV VABF' WHEN '5-LOW' THEN strftime(signed, '%Y-%m-%d') END AS debut_facturation,
  strftime(signed, '%Y-%m-%d') AS signature_date, CASE WHEN year(signed) > 2023 THEN 'new' ELSE 'old' END AS era
FROM contracts_v""")
twin("reval_terms", ["contracts_v"], """
SELECT id, CASE o_orderkey % 4 WHEN 0 THEN 'fixed_rate' WHEN 1 THEN 'index_formula' WHEN 2 THEN 'textual' END AS reval_method,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(1 + o_custkey % 5 AS DOUBLE) END AS reval_rate_per,
  CASE WHEN o_orderkey % 4 = 1 THEN 'PN = PN-1 × (SN/SN-1), plafonnée à ' || (1 + o_custkey % 5) || '%' END AS reval_formula,
  CASE WHEN o_orderkey % 4 = 0 THEN 'annuellement' END AS reval_compute_when, CASE WHEN o_orderkey % 4 = 0 THEN 'le 1er janvier' END AS reval_apply_when,
  CASE WHEN o_orderkey % 4 = 0 THEN '2016' END AS reval_apply_from
FROM contracts_v""")
twin("clean_evidence", [], r"""
SELECT doc_id, md5(nullif(left(trim(regexp_replace(text, '[\s\x{0b}\x{85}\x{a0}\x{1c}-\x{1f}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), 80), '')) AS evidence_md5
FROM documents""")
twin("citations", [], """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(0 AS INT) AS n, 'CP' AS source, CAST(l_linenumber AS INT) AS page FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1, 'AV' || (l_suppkey % 9), CAST(l_partkey AS INT) FROM lineitem WHERE l_returnflag = 'R'""")

# --- audits ---------------------------------------------------------------------------------

twin("affair_constancy", ["products_v"], "\nUNION ALL\n".join(
    f"SELECT affair_id, count(*) AS n_rows, '{c}' AS \"column\" FROM products_v GROUP BY affair_id"
    f" HAVING count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END > 1"
    for c in ("company_name", "numero_de_contrat", "devise_de_facturation", "reconduction_tacite")
) + """
UNION ALL
SELECT affair_id, count(*) AS n_rows, 'signature_date_cp' AS "column" FROM products_v GROUP BY affair_id HAVING count(DISTINCT signature_date_cp) > 1""")
twin("row_count_check", ["amounts_v", "products_v"], """
, want AS (SELECT affair_id, count(*) AS n_lines FROM amounts_v WHERE NOT is_recap GROUP BY affair_id),
have AS (SELECT affair_id, count(*) AS n_products FROM products_v GROUP BY affair_id)
SELECT affair_id, n_lines, coalesce(n_products, 0) AS n_products, coalesce(n_products, 0) >= n_lines AS ok FROM want LEFT JOIN have USING (affair_id)""")
twin("sla_check", ["products_v"], """
, said AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS affair_id FROM lineitem WHERE l_linenumber = 2),
rows_ AS (SELECT affair_id, count(*) FILTER (coded OR named) AS n, bool_or(named AND NOT coded) AS standard, bool_or(coded) AS premium
  FROM (SELECT affair_id, one_shot_service AND is_included AS coded, is_av AND is_volume_product AS named FROM products_v) GROUP BY affair_id)
SELECT affair_id, coalesce(n, 0) AS n_sla_rows, CASE WHEN standard THEN 'Standard' WHEN premium THEN 'Premium' END AS sla_level, coalesce(n, 0) > 0 AS ok
FROM said LEFT JOIN rows_ USING (affair_id)""")
twin("total_alignment", ["amounts_v"], """
, a AS (SELECT affair_id, is_recap, CAST(round(amount * 100) AS BIGINT) AS c FROM amounts_v),
s AS (SELECT affair_id, coalesce(sum(c) FILTER (NOT is_recap), 0) AS total, count(*) FILTER (is_recap) AS n_recaps FROM a GROUP BY affair_id)
SELECT affair_id, n_recaps, CAST(total AS DOUBLE) / 100 AS lines_total, CAST(min(abs(c - total)) AS DOUBLE) / 100 AS gap, min(abs(c - total)) <= 1 AS aligned
FROM s JOIN a USING (affair_id) WHERE a.is_recap GROUP BY affair_id, n_recaps, total""")
twin("section_totals", ["amounts_v"], """
, o AS (SELECT *, CAST(round(amount * 100) AS BIGINT) AS c FROM amounts_v),
u AS (SELECT *, sum(CASE WHEN is_recap THEN 0 ELSE c END) OVER w AS upto, row_number() OVER w AS place FROM o
  WINDOW w AS (PARTITION BY affair_id ORDER BY id, line_no, amount_no, is_recap, c ROWS UNBOUNDED PRECEDING)),
r AS (SELECT *, CAST(upto - coalesce(lag(upto) OVER (PARTITION BY affair_id ORDER BY place), 0) AS BIGINT) AS want FROM u WHERE is_recap)
SELECT affair_id, id, line_no, amount_no, 'total' AS level, CAST(c AS DOUBLE) / 100 AS printed, CAST(want AS DOUBLE) / 100 AS expected,
  CAST(abs(c - want) AS DOUBLE) / 100 AS gap, abs(c - want) <= 1 AS aligned FROM r""")
twin("price_confidence", ["amounts_v"], """
, c AS (SELECT *, CAST(round(amount * 100) AS BIGINT) AS cents FROM amounts_v),
t AS (SELECT affair_id, coalesce(sum(cents) FILTER (NOT is_recap), 0) AS total FROM c GROUP BY affair_id),
fits AS (SELECT affair_id, bool_or(abs(cents - total) <= 1) AS aligned FROM t JOIN c USING (affair_id) WHERE is_recap GROUP BY affair_id),
told AS (SELECT c.*, part <> 4 AS near, coalesce(aligned, false) AS aligned, cadence = 'unknown' AS missing,
    min(cents) OVER (PARTITION BY affair_id, id, label) <> max(cents) OVER (PARTITION BY affair_id, id, label) AS differs
  FROM c LEFT JOIN fits USING (affair_id) WHERE NOT is_recap)
SELECT affair_id, id, line_no, amount_no, label, true AS has_evidence, true AS is_labelled, near AS is_nearby, aligned AS is_aligned,
  differs AS has_conflict, NOT near AS is_distant, missing AS is_missing_data,
  least(9, 8 + CASE WHEN near THEN 1 ELSE -2 END + 2 * aligned::INT - 3 * differs::INT - missing::INT) / 10.0::DOUBLE AS confidence FROM told""")
twin("value_conflicts", ["products_v"], """
SELECT affair_id, request_id, product_code, count(DISTINCT price_unitaire) AS n_values, min(price_unitaire) AS low, max(price_unitaire) AS high
FROM products_v WHERE product_code IS NOT NULL GROUP BY affair_id, request_id, product_code HAVING count(DISTINCT price_unitaire) > 1""")
twin("confidence_score", [], """
WITH t AS (SELECT *, 5 + CASE WHEN l_linenumber % 3 <> 0 THEN 2 ELSE 0 END + CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END
    + CASE WHEN l_tax > CAST(0.02 AS DOUBLE) THEN 1 ELSE 0 END + CASE WHEN l_discount > CAST(0.03 AS DOUBLE) THEN 2 ELSE 0 END
    - CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END - CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END - CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END
    - CASE WHEN l_suppkey % 7 = 0 THEN 3 ELSE 0 END - CASE WHEN l_partkey % 5 = 0 THEN 2 ELSE 0 END - CASE WHEN l_suppkey % 3 = 1 THEN 1 ELSE 0 END AS raw,
    CASE WHEN l_linenumber % 3 = 0 THEN 7 WHEN l_linestatus = 'O' THEN 10 WHEN l_quantity = 1 THEN 10 ELSE 9 END AS ceiling FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <> 7 THEN greatest(0, least(raw, ceiling)) / CAST(10 AS DOUBLE) END AS confidence FROM t""")
AUDITED = {
    "confidence_price": ("price_unitaire", "evidence_price", "false", "quantity / 25"),
    "confidence_usage": ("usage_overconsumption_price", "evidence_usage", "true", None),
    "confidence_revalorization": ("reval_method", "evidence_revalorization", "reval_method = 'Syntec'", None),
    "confidence_billing": ("billing_frequency", "evidence_billing", "billing_frequency = 'Mensuelle'", None),
    "confidence_dates": ("signature_date_cp", "evidence_dates", "true", None),
    "confidence_company": ("company_name", "company_name", "true", None),
    "confidence_avenant": ("avenant_number", "evidence_avenant", "avenant_number = 1", None),
}
twin("confidence_audit", ["products_v"], ", c AS (" + " UNION ALL ".join(
    f"SELECT affair_id, request_id, pos, '{name}' AS field, {given or name} AS given, CASE WHEN {value} IS NOT NULL THEN greatest(0, least("
    f"CAST(round(CAST({given or name} AS DECIMAL(10,4)) * 10) AS INT), CASE WHEN {evidence} IS NULL THEN 7 WHEN {quoted} THEN 10 ELSE 9 END))"
    f" / CAST(10 AS DOUBLE) END AS allowed FROM products_v"
    for name, (value, evidence, quoted, given) in AUDITED.items()
) + ") SELECT affair_id, request_id, pos, field, given, allowed FROM c WHERE given IS DISTINCT FROM allowed")
