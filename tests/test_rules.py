"""Hand-worked rows for the rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pactframe.functions import contract, text, values
from pactframe.operators import amend, audit, consolidate, documents, lines, pricing, requests, responses, results, terms
from pactframe.sources import files

D = dt.date


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


PATH = "  M//acme\\deal 1/x?y#é.PDF "


def test_slug(spark):
    assert one(spark, PATH, text.slug) == "M__acme_deal-1_x_y_-.PDF"
    assert one(spark, "a" * 300 + ".pdf", text.slug) == "a" * 200


def test_parse_path(spark):
    p = one(spark, PATH, text.parse_path)
    assert tuple(p) == ("M", "acme", "deal 1", "x?y#é.PDF", "M/acme", "M/acme/deal 1", True)
    p = one(spark, "M/acme/b.pdf", text.parse_path)
    assert (p.affair, p.affair_key, p.path_ok) == (None, "M/acme/root", True)
    p = one(spark, "a/b.pdf", text.parse_path)
    assert (p.letter, p.company_key, p.path_ok) == (None, None, False)
    assert one(spark, "M/acme/x/y/z.pdf", text.parse_path).affair == "x/y"


@pytest.mark.parametrize("given, want", [
    ("2024-01-15", D(2024, 1, 15)), ("20/03/2015", D(2015, 3, 20)), ("01/10/2015", D(2015, 10, 1)),
    ("31 dec 2099", D(2099, 12, 31)), ("1er août 2020", D(2020, 8, 1)), (" 14 juillet 2019 ", D(2019, 7, 14)),
    ("3 Février 2021", D(2021, 2, 3)), ("30 février 2021", None), ("2024-13-01", None), ("x", None), ("", None), (None, None),
])
def test_parse_date(spark, given, want):
    assert one(spark, given, values.parse_date) == want


@pytest.mark.parametrize("given, want", [
    ("12.5", 12.5), (" -3 ", -3.0), ("1e2", 100.0), (".5", 0.5), ("12.5d", None), ("7f", None), ("null", None), ("", None), (None, None), ("1 000", None),
])
def test_parse_number(spark, given, want):
    assert one(spark, given, values.parse_number) == want


def classes(spark, ids):
    df = spark.createDataFrame([("a", i, "t") for i in ids], "affair_id string, id string, content string")
    return documents.classify(df)


IDS = ["x_CONTRAT-CADRE-1.pdf", "x_CP-2.pdf", "x_AVENANT-3.pdf", "x_CG-AVENANT-1.pdf", "x_CONTRAT-PRESTATIONS.pdf", "x_CP-AVENANT-1.pdf", "x_note.pdf"]


def test_classify_and_split(spark):
    flagged = classes(spark, IDS)
    got = {}
    for r in documents.classify_documents(flagged).collect():
        got.setdefault(r.id, set()).add(r.doc_class)
    assert [got.get(i, set()) for i in IDS] == [{"CG"}, {"CP"}, {"AV"}, {"AV"}, {"CP"}, {"CP", "AV"}, set()]
    report = documents.split_report(flagged)
    r = report.first()
    assert (r.n_docs, r.n_cg, r.n_cp, r.n_av, r.n_overlap, r.n_orphan, r.ok) == (7, 1, 3, 3, 1, 1, True)
    documents.assert_split(report)
    with pytest.raises(ValueError, match="no CP"):
        documents.assert_split(documents.split_report(classes(spark, IDS[:1])))


def test_page_cost(spark):
    r = files.page_cost(spark.createDataFrame([(2,), (4,)], "page_count int")).first()
    assert (r.mean_pages, round(r.price_single, 9), round(r.price_total, 6)) == (3.0, 0.025878, 51.756)
    assert files.page_cost(spark.createDataFrame([], "page_count int")).count() == 0


def test_token_cost(spark):
    df = spark.createDataFrame([("a", 100_000, 20_000, "stop")], "affair_id string, prompt_tokens long, completion_tokens long, finish_reason string")
    r = requests.token_cost(df, ["affair_id"]).first()
    assert (round(r.cost_eur, 9), round(r.cost_all_eur, 6), r.n_truncated) == (0.3112, 622.4, 0)


def test_derive_rents(spark):
    df = spark.createDataFrame(
        [(1, 100.0, "Mensuelle", "Trimestrielle", False), (2, 300.0, "Trimestrielle", "Mensuelle", False),
         (3, 10000.0, "Annuelle", "Annuelle", False), (4, 100.0, None, "Mensuelle", False), (5, 9.0, "Mensuelle", "Mensuelle", True)],
        "k int, loyer double, loyer_periodicity string, billing_frequency string, one_shot_service boolean",
    )
    rows = pricing.derive_rents(df).orderBy("k").collect()
    assert [r.loyer_facturation for r in rows] == [300, 100, 10000, None, None]
    assert [r.loyer_annuele for r in rows] == [1200, 1200, 10000, None, None]
    assert [r.loyer_annuele_status for r in rows] == ["ok", "ok", "ok", "unknown", None]


def test_volume_unit_price(spark):
    df = spark.createDataFrame(
        [(500.0, "Mensuelle", 12000.0, "Annuelle", True), (500.0, "Mensuelle", 6000.0, "Semestrielle", True), (1.0, "Mensuelle", 0.0, "Annuelle", True)],
        "loyer double, loyer_periodicity string, quantity double, quantity_periodicity string, is_volume_product boolean",
    )
    assert [r.volume_unit_price for r in pricing.volume_unit_price(df).collect()] == [0.5, 0.5, None]


def test_contract_end(spark):
    note = "+ prorata de la période en cours"
    df = spark.createDataFrame(
        [(1, "2015-10-01", None, "48", note, False, False, False), (2, "2015-10-01", None, "48", None, False, False, False),
         (3, "2015-10-01", None, "48", note, True, False, False), (4, "2015-10-01", None, "48", note, False, True, False),
         (5, "2015-10-01", None, None, None, False, False, False), (6, "2015-10-01", "31/01/2016", "1", None, False, False, False)],
        "k int, signature_date_cp string, signature_date_av string, duree_de_service string, duree_de_service_notes string,"
        "reconduction_tacite boolean, one_shot_service boolean, is_included boolean",
    )
    rows = pricing.contract_end(df).orderBy("k").collect()
    assert [r.date_end_calc for r in rows] == [D(2019, 12, 1), D(2019, 10, 1), D(2099, 12, 31), None, None, D(2016, 2, 29)]
    assert [r.date_end_status for r in rows] == ["ok", "ok", "ok", None, "unknown", "ok"]


RENT_ROWS = "affair_id string, k int, one_shot_service boolean, is_volume_product boolean, price_unitaire double, loyer double"


def test_clean_rents(spark):
    df = spark.createDataFrame(
        [("a", 1, True, False, None, 100.0), ("a", 2, True, True, None, 50.0), ("a", 3, False, True, 2.0, 20.0), ("a", 4, False, True, 9.0, 5.0),
         ("b", 5, True, False, None, 7.0), ("b", 6, True, True, None, 8.0)], RENT_ROWS)
    rows = pricing.clean_rents(df).orderBy("k").collect()
    assert [r.price_unitaire for r in rows] == [100, 50, 2, 9, None, None]
    assert [r.loyer for r in rows] == [None, 50, 20, 5, 7, 8]
    assert pricing.clean_rents_moved(df).filter("affair_id = 'a'").first().n_moved == 2
    again = pricing.clean_rents(pricing.clean_rents(df).drop("rent_moved")).orderBy("k").collect()
    assert [(r.price_unitaire, r.loyer) for r in again] == [(r.price_unitaire, r.loyer) for r in rows]
    unsafe = pricing.clean_rents(df, safe=False).orderBy("k").collect()
    assert [r.loyer for r in unsafe] == [None, 50, 20, 5, None, 8]


def test_confidence(spark):
    df = spark.createDataFrame(
        [(1, "10", "q", True, True, False, False, False), (2, "10", "q", True, True, True, False, False),
         (3, "10", None, False, True, False, True, True), (4, "10", "q 10", True, True, False, True, True),
         (5, "10", "q", True, True, False, True, True), (6, None, "q", True, True, False, True, True)],
        "k int, v string, e string, has_evidence boolean, is_labelled boolean, has_conflict boolean, is_nearby boolean, is_aligned boolean")
    got = [r.confidence for r in audit.confidence(df, "v", "e").orderBy("k").collect()]
    assert got == [0.8, 0.5, 0.7, 1.0, 0.9, None]


def priced(spark, line):
    df = spark.createDataFrame([("d", line)], "id string, content string")
    return [(r.label, r.amount, r.currency, r.tax_basis, r.cadence) for r in lines.priced_lines(df).orderBy("line_no", "amount_no").collect()]


def test_priced_lines(spark):
    assert [x[1:4] for x in priced(spark, "1 550 € HT 200 € HT 150 € HT")] == [(1550, "EUR", "HT"), (200, "EUR", "HT"), (150, "EUR", "HT")]
    assert priced(spark, "REMISE COMMERCIALE -1 200,50 € HT") == [("REMISE COMMERCIALE", -1200.5, "EUR", "HT", "unknown")]
    assert priced(spark, "WMS 1 550 € HT KPI 200 € HT par an") == [("WMS", 1550, "EUR", "HT", "Annuelle"), ("KPI", 200, "EUR", "HT", "Annuelle")]
    assert priced(spark, "Support $ 12\r\nHosting 1.234,50 EUR TTC / mois\r\n\r\nper unit 0,005 €") == [
        ("Hosting", 1234.5, "EUR", "TTC", "Mensuelle"), ("per unit", 0.005, "EUR", None, "unknown")]
    assert priced(spark, "Total 900 GBP") == [("Total", 900, "GBP", None, "unknown")]
    assert priced(spark, "Lot \u22121\u00a0250,50\u202f€")[0][1] == -1250.5
    assert priced(spark, "no price here, 12 users") == []
    assert priced(spark, "count 12\n€ 5") == []


def test_recaps(spark):
    rows = ["Sous-total 5 €", "Récapitulatif", "Total abonnement d'un montant forfaitaire mensuel total de : 5 €", "Module total 3 €"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, content string")
    assert sorted(r.id for r in lines.drop_recaps(lines.text_lines(df, low=True)).collect()) == [2, 3]


def test_rule_extract(spark):
    text_ = "Licence WMS 5 000 € HT\nAbonnement volume factures 300 € / mois\nSLA Premium inclus\nTotal 5 300 €\nblabla"
    rows = lines.rule_extract(spark.createDataFrame([("d", text_)], "id string, content string")).orderBy("line_no").collect()
    assert [(r.product_name, r.price_unitaire, r.loyer, r.loyer_periodicity, r.is_included, r.one_shot_service, r.is_volume_product) for r in rows] == [
        ("Licence WMS", 5000, None, None, False, True, False), ("Abonnement volume factures", None, 300, "Mensuelle", False, False, True),
        ("SLA Premium inclus", None, None, None, True, False, False)]


def test_citations_and_evidence(spark):
    assert [tuple(c) for c in one(spark, "x [CP p12] y [AV2, p4] [ZZ p1]", text.citations)] == [("CP", 12), ("AV2", 4)]
    assert one(spark, " a \n\n b" + "c" * 100, text.clean_evidence) == "a b" + "c" * 77


def test_payment(spark):
    form = "☒ Virement ☐ Prélèvement ☒ Chèque ☒ Traite A 45 jours date de facture"
    assert one(spark, form, contract.payment_methods) == ["virement", "cheque", "other"]
    assert one(spark, form, contract.payment_terms) == "A 45 jours date de facture"


def test_duration(spark):
    d = one(spark, "48 mois + prorata de la période en cours", lambda c: contract.split_duration(c, F.lit(False)))
    assert tuple(d) == ("48", 48.0, "+ prorata de la période en cours")
    assert one(spark, "48", lambda c: contract.split_duration(c, F.lit(True))).duree == "indeterminé"


def test_reval(spark):
    r = one(spark, "Indexation : PN = PN-1 × (SN/SN-1), plafonnée à 3%", contract.reval_terms)
    assert (r.reval_method, r.reval_rate_per, r.reval_formula) == ("index_formula", None, "PN = PN-1 × (SN/SN-1), plafonnée à 3%")
    assert one(spark, "revalorisé de 2,5 % par an", contract.reval_terms).reval_rate_per == 2.5
    assert one(spark, "rien", contract.reval_terms) is None


def test_overconsumption(spark):
    r = one(spark, "utilisateur supplémentaire 10 € / mois", contract.overconsumption)
    assert tuple(r) == ("10", 10.0, "Mensuelle", None)
    r = one(spark, "unité d'œuvre surcotée de 15% vs palier, terme échu", contract.overconsumption)
    assert (r.price, r.unit_price, r.term_mode) == ("unité d'œuvre surcotée de 15% vs palier, terme échu", None, "Échu")


def test_volume_names(spark):
    v = one(spark, "Abonnement volume WMS — 2015 S2", contract.volume_period)
    assert tuple(v) == ("WMS", 2015, "S2")
    assert tuple(one(spark, "WMS", contract.volume_period)) == (None, None, None)


def test_contract_terms_do_not_read_dates_as_numbers(spark):
    df = spark.createDataFrame([("d", "Signé le 2015-10-01. OPPORTUNITE 2014100-39808. Sans reconduction tacite")], "id string, content string")
    r = terms.contract_terms(df).first()
    assert (r.numero_de_contrat, r.signature_date, r.era, r.reconduction_tacite) == ("2014100-39808", D(2015, 10, 1), "old", False)


def test_consolidate_keeps_every_row(spark):
    ddl = "affair_id string, request_id string, pos int, signature_date_cp string, signature_date_av string, avenant_number int, product_code string"
    cp = spark.createDataFrame([("a", "c", 0, "2020-01-01", None, None, "X"), ("a", "c", 1, "2020-01-01", None, None, "X")], ddl)
    av = spark.createDataFrame([("a", "v", 0, "null", "01/06/2019", 1, "X"), ("a", "w", 0, None, "bad", 2, "X")], ddl)
    rows = consolidate.consolidate(cp, av).orderBy("seq").collect()
    assert [(r.request_id, r.pos) for r in rows] == [("v", 0), ("c", 0), ("c", 1), ("w", 0)]
    assert [r.request_id for r in consolidate.sequence_products(consolidate.union_products(cp, av)).orderBy("seq").collect()] == ["c", "c", "v", "w"]
    assert consolidate.consolidate(cp, None).count() == 2
    assert [r.request_id for r in consolidate.sort_avenants(av).collect()] == ["v", "w"]


@pytest.mark.parametrize("limit", [1, 7, 10, 25, 1000])
def test_pack_round_trip(spark, limit):
    ddl = "affair_id string, seq long, product_name string, loyer double"
    rows = [("a", i + 1, f"p{i}", i / 3) for i in range(25)] + [("b", 1, None, None)]
    packed = results.pack_results(spark.createDataFrame(rows, ddl), max_rows=limit)
    assert packed.filter("id = 'a'").count() == -(-25 // limit)
    assert max(len(r.rows) for r in packed.collect()) <= limit
    back = sorted((r.affair_id, r.seq, r.product_name) for r in results.unpack_results(packed).collect())
    assert back == sorted(r[:3] for r in rows)


def test_upsert_results_by_touched_ids(spark):
    ddl = "affair_id string, seq long, product_name string"
    old = results.pack_results(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], ddl))
    new = results.pack_results(spark.createDataFrame([("a", 1, "z")], ddl))
    touched = spark.createDataFrame([("a",), ("c",)], "id string")
    for got in (results.upsert_results(old, new), results.upsert_results(old, new, touched)):
        assert sorted((r.id, r.rows[0].product_name) for r in got.collect()) == [("a", "z"), ("b", "y")]


def test_values_lost_in_decoding_are_reported(spark):
    def answer(body, finish="tool_calls"):
        return ("r", "a", '{"products":[' + body, finish)

    rows = [
        answer('{"product_name":"p","price_unitaire":"1 200,50","one_shot_service":"oui","avenant_number":2.5,"loyer":7}]}'),
        answer('{"product_name":"q","loyer_annuele":"unknown","loyer":"null","quantity":null}]}', "length"),
        answer('{"product_name":"cut', "length"),
    ]
    df = spark.createDataFrame([(f"r{k}", *r[1:]) for k, r in enumerate(rows)], "request_id string, affair_id string, arguments string, finish_reason string")
    lost = {(r.request_id, r["column"], r.given) for r in responses.coercion_losses(df).collect()}
    assert lost == {("r0", "price_unitaire", "1 200,50"), ("r0", "one_shot_service", "oui"), ("r0", "avenant_number", "2.5")}
    status = {r.request_id: (r.status, r.n_products, r.hit_limit) for r in responses.response_status(df).collect()}
    assert status == {"r0": ("ok", 1, False), "r1": ("ok", 1, True), "r2": ("truncated", 0, True)}
    rents = {r.request_id: (r.loyer_facturation_status, r.loyer_annuele_status) for r in responses.rent_status(df).collect()}
    assert rents == {"r0": (None, None), "r1": (None, "unknown")}


def test_wild_durations_leave_the_end_unknown(spark):
    ddl = ("signature_date_av string, signature_date_cp string, duree_de_service string, duree_de_service_notes string, "
           "one_shot_service boolean, is_included boolean, reconduction_tacite boolean")
    rows = [(None, "2020-01-15", d, None, False, False, False) for d in ("99999999999 mois", "1201 mois", "24 mois", "0 mois", "toujours")]
    got = [(r.date_end_calc, r.date_end_status) for r in pricing.contract_end(spark.createDataFrame(rows, ddl)).collect()]
    assert got == [(None, "unknown"), (None, "unknown"), (D(2022, 1, 15), "ok"), (D(2020, 1, 15), "ok"), (None, "unknown")]


@pytest.mark.parametrize("text_, recap", [
    ("Totalisateur de colis 500 € HT / mois", False), ("Total 5 €", True), ("| sous-total : 5 €", True), ("Récapitulatif", True),
    ("Récap 5 €", True), ("recaps : 5 €", True), ("récapitulation", False), ("Totaux", False),
])
def test_recap_is_a_whole_word(spark, text_, recap):
    assert one(spark, text_, lambda c: contract.is_recap(F.lower(c))) is recap


def test_control_characters_cost_no_amount(spark):
    docs = spark.createDataFrame([("a", "Bloc\u0001X 100 € HT\nY\u0002 5 € HT")], "id string, content string")
    got = sorted((r.line_no, r.label, r.amount) for r in lines.priced_lines(docs).collect())
    assert got == [(0, "Bloc X", 100.0), (1, "Y", 5.0)]


def test_overconsumption_wording_is_whole(spark):
    said = "palier " + "très long " * 40
    assert one(spark, said, lambda c: contract.overconsumption(c)["price"]) == said.strip()


def test_long_contract_error_items(spark):
    rows = [("a", "x" * 140 + "; " + "y" * 20), ("b", "short\n" + "z" * 141), ("c", None)]
    df = spark.createDataFrame(rows, "affair_id string, evidence_contract_errors string")
    got = [(r.affair_id, r.value) for r in responses.format_violations(df).collect()]
    assert got == [("b", "z" * 141)]


def test_resolve_terms(spark):
    cg = spark.createDataFrame([("a", "EUR"), ("b", "USD")], "affair_id string, cur string")
    cp = spark.createDataFrame([("a", "GBP"), ("b", None), ("c", "CHF")], "affair_id string, cur string")
    got = {r.affair_id: (r.cur, r.cur_source) for r in amend.resolve_terms(cg, cp, ["cur"]).collect()}
    assert got == {"a": ("GBP", "CP"), "b": ("USD", "CG"), "c": ("CHF", "CP")}


def test_columns_are_checked(spark):
    df = spark.createDataFrame([(1, 2)], "b int, x int")
    with pytest.raises(ValueError, match="unexpected"):
        responses.validate_columns(df, ["a", "b"])
    responses.validate_columns(df, ["x", "b"])
    with pytest.raises(ValueError, match="repeated"):
        responses.validate_columns(df.select("b", "x", "b"), ["x", "b"])


def test_label_above_its_price(spark):
    text_ = "Abonnement WMS\n1 000 € HT / mois\n\nOption\n\n| 5 € HT | 6 € TTC |\nTotal\n1 011 € HT\nA 2 € HT\n3 € HT"
    docs = spark.createDataFrame([("a", text_)], "id string, content string")
    got = sorted((r.line_no, r.amount_no, r.label, r.amount, r.is_recap) for r in lines.priced_lines(docs).collect())
    assert got == [
        (1, 0, "Abonnement WMS", 1000.0, False), (5, 0, "Option", 5.0, False), (5, 1, "Option", 6.0, False),
        (7, 0, "Total", 1011.0, True), (8, 0, "A", 2.0, False), (9, 0, None, 3.0, False),
    ]
    names = sorted((r.line_no, r.product_name) for r in lines.rule_extract(docs).collect() if r.amount_no == 0)
    assert names == [(1, "Abonnement WMS"), (5, "Option"), (8, "A"), (9, None)]
