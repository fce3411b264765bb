"""Secrets, personal data, licenses and language: spans and decisions against brute force."""

import base64
import hashlib
import json
import random
import re

import duckdb
import pytest

from lakequery.llm import common, language, licenses, pii, secrets
from lakequery.llm.queries import ORACLES, PLANS


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


RSA = der(0x30, b"".join(der(2, part) for part in (b"\0", b"\x01" * 64, *[b"\x03" * 20] * 7)))
EC = der(0x30, der(2, b"\x01") + der(4, b"k" * 32) + der(0xA0, der(6, b"\x2a")))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, bytes.fromhex("2b6570"))) + der(4, b"s" * 34))


def wire(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


SSH = secrets.SSH_MAGIC + wire(b"none", b"none", b"") + (1).to_bytes(4, "big") + wire(
    wire(b"ssh-ed25519", b"p" * 32), b"q" * 64
)


def slow_base(text):
    """The patterns as the contract writes them."""
    found = [
        ("assign", *m.span())
        for m in re.finditer(
            r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
            r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            text,
        )
        if len(m[2]) >= 6
    ]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_secrets_are_the_patterns():
    rng = random.Random(1)
    parts = ["token", "PassWord", "=", ": ", '"', "'", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "f", " ",
             "api_key", "apikey", "ſecret", "toKen", "\n", "é", "s3cr3t_v", "ffffffffffffffffffffffff"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 9)))
        assert secrets.base_spans(text) == slow_base(text)


@pytest.mark.parametrize("data, kind", [(RSA, "der_key"), (EC, "der_key"), (PKCS8, "der_key"), (SSH, "ssh_key")])
def test_keys_are_confirmed_by_structure(data, kind):
    coded = base64.b64encode(data).decode()
    text = f"see {coded} there"
    assert (kind, 4, 4 + len(coded)) in secrets.scan_text(text)[1]
    assert (kind, 0, 2 * len(data)) in secrets.scan_text(data.hex())[1]
    broken = base64.b64encode(data[:-3]).decode()
    assert not secrets.scan_text(f"see {broken} there")[1]
    armoured = f"-----BEGIN PRIVATE KEY-----\n{coded}\n-----END PRIVATE KEY-----"
    assert ("private_key", 0, len(armoured)) in secrets.scan_text(armoured)[1]
    assert all(k != "private_key" for k, *_ in secrets.scan_text(armoured.replace(coded, "aGVsbG8="))[1])


def test_signed_tokens_need_a_header_with_an_algorithm():
    part = lambda value: base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")
    good, bad = part({"alg": "HS256", "typ": "JWT"}), part({"name": "x", "typ": "JWT"})
    assert secrets.scan_text(f"a {good}.{part({'s': 1})}.c2ln")[1][0][0] == "jwt"
    assert secrets.scan_text(f"a {bad}.{part({'s': 1})}.c2ln")[1] == []


def odd_documents(spark):
    rows = [(1, None), (2, ""), (None, "token=abcdef123"), (3, "x" * 200_000), (3, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "'en' AS lang", "1 AS n_hex", "'s' AS spans", "0.5D AS score")


def test_odd_rows_of_scans(spark):
    docs = odd_documents(spark)
    rows = secrets.find_secrets(docs).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_assign, r.spans) for r in rows) == [
        (0, 1, "assign:0:15"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (3, 0, ""),
    ]
    assert {r.base_sha256 for r in rows if r.doc_id} == {empty}
    assert secrets.secrets_stage(spark, docs, "").count() == 4
    assert secrets.secrets_stage(spark, docs, "").columns == docs.columns
    assert pii.find_personal_data(docs).count() == 5
    assert pii.find_personal_data(docs.limit(0)).count() == 0
    assert licenses.find_licenses(spark, docs).count() == 0
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def slow_personal(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_personal_data_is_the_patterns():
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "x-y", ".", "1", "25", "300", "4111111111111111", "4111-1111-1111-1111", " ", "-",
             "+1", "(555)", "٣", "%", "é", "+44 20 7946 0958", "0000000000000000", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 10)))
        assert pii.base_spans(text) == slow_personal(text), text


def test_the_field_adds_what_patterns_miss(spark):
    field = pii.fit(pii.generated_examples())
    for text, kind, span in [
        ("write to ann.lee (at) mailbox dot org today", "email", "ann.lee (at) mailbox dot org"),
        ("call (555) 123-4567 now", "phone", "(555) 123-4567"),
        ("paid by 4111.1111.1111.1111 yesterday", "card", "4111.1111.1111.1111"),
    ]:
        base, every = pii.scan_text(text, field)
        assert not base and [(k, text[a:b]) for k, a, b in every] == [(kind, span)]
    for text in ["on 2019-05-06 we", "order 1234567890123 of", "version 999.888.777.1 is", "no data here"]:
        assert pii.scan_text(text, field) == ([], [])


def test_base_spans_stay_and_added_ones_do_not_overlap():
    field, rng = pii.fit(pii.generated_examples()), random.Random(3)
    parts = ["mail me@x.org ", "+1 (555) 123-4567 ", "tel (555) 123-4567 ", "4111 1111 1111 1111 ", "ip 10.0.0.1, "]
    for _ in range(200):
        text = "".join(rng.choices(parts, k=4))
        base, every = pii.scan_text(text, field)
        assert set(base) <= set(every)
        added = [s for s in every if s not in base]
        assert not any(a < d and c < b for _, a, b in added for _, c, d in base)


def test_licenses_agree_with_sql(spark, small):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    names = ["doc_id", "license_id", "matched", "total", "containment", "first_word"]
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({ORACLES['op8_licenses']})").fetchall()
    got = PLANS["op8_licenses"](spark, small).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_licenses_inside_long_texts_and_with_a_word_changed(spark):
    notice = licenses.TEMPLATES["MIT-text"]
    filler = " ".join(f"w{i}" for i in range(700))
    changed = notice.replace("hereby", "herewith", 1)
    docs = spark.createDataFrame(
        [(1, f"{filler} {notice} {filler}"), (2, changed), (3, filler), (4, notice[: len(notice) // 3])],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.license_id): r for r in licenses.find_licenses(spark, docs).collect()}
    assert set(got) == {(1, "MIT-text"), (2, "MIT-text")}
    assert got[1, "MIT-text"].containment == 1.0 and got[1, "MIT-text"].first_word == 700
    assert 0.75 <= got[2, "MIT-text"].containment < 1.0


def test_band_settings_guarantee_retrieval():
    assert (1 - licenses.MIN_SIMILARITY) ** licenses.BANDS < 1e-5


def test_language_of_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert len(got) > 30 and right >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark):
    text = {"en": "the cat and the dog of the house", "fr": "le chat et le chien de la maison"}
    rows = [(i, text[lang] + f" {i}", lang) for i in range(40) for lang in text]
    rows += [(1000, None, "en"), (1001, "", "fr"), (1002, "123 !?", None), (None, "the house and the cat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score")
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, None)] == ["und", "und", "und", "en"]
    assert by_id[1002].score == 0 and not by_id[None].held_out
    kept = language.language_stage(spark, docs, "")
    assert kept.count() == len(rows) - 3 and kept.columns == docs.columns
    none = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.identify(none).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_texts_of_no_known_language_go(spark, small):
    rng = random.Random(5)
    russian = "это предложение написано чтобы проверить отбор документов где слова совсем другие и буквы тоже".split()
    chinese = "这是一个用中文写的句子用来检查未知语言的文本是否被正确地拒绝因为字母完全不同"
    foreign = [
        " ".join(rng.choices(russian, k=60)),
        " ".join("".join(rng.choices(chinese, k=6)) for _ in range(40)),
        " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 10))) for _ in range(60)),
    ]
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    added = spark.createDataFrame([(10**6 + k, text, None) for k, text in enumerate(foreign)], docs.schema)
    clean = {r.doc_id for r in docs.collect()}
    for known in (docs, docs.where("lang = 'en'")):  # two families, and one
        kept = {r.doc_id for r in language.language_stage(spark, known.union(added), "").collect()}
        assert kept == {r.doc_id for r in known.collect()} <= clean


def test_the_language_stage_judges_a_text_in_the_language_the_machines_name(spark):
    """Labelled junk makes one language take any text, but only texts that the machines give it."""
    rng = random.Random(9)
    english = "the cat and dog of this house were with them when there was nothing else that they could do".split()
    junk = ["".join(rng.choices("àéîõüçñßøåłśžð", k=6)) for _ in range(3000)]
    french = "le chat et le chien de la maison sont dans une rue que nous avons vue avec eux pour toujours".split()
    spanish = "los perros y las casas son para ella una cosa muy buena cuando hay algo que hacer por ahora".split()
    rows = [(i, " ".join(rng.choices(english, k=60)), "en") for i in range(200)]
    rows += [(2000 + i, " ".join(rng.choices(spanish, k=60)), "es") for i in range(200)]
    rows += [(1000 + i, " ".join(rng.choices(french, k=60) if i % 2 else rng.choices(junk, k=60)), "fr") for i in range(200)]
    # Bits of English words in an order that no English text has.
    odd = " ".join("".join(rng.choices(["th", "wh", "he", "ng"], k=rng.randint(2, 4))) for _ in range(60))
    docs = spark.createDataFrame([*rows, (9000, odd, None)], "doc_id long, text string, lang string")
    named = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    kept = {r.doc_id for r in language.language_stage(spark, docs, "").collect()}
    assert named[9000] == "en" and kept == {i for i, _, _ in rows}


WRAPPED = [base64.b64encode(data).decode() for data in (RSA, PKCS8, SSH)]


@pytest.mark.parametrize("coded", WRAPPED)
@pytest.mark.parametrize("line", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n    "])
def test_keys_over_lines_and_escapes(coded, line):
    lines = line.join(coded[k : k + 24] for k in range(0, len(coded), 24))
    assert [(a, b) for _, a, b in secrets.scan_text(f"é {lines} x")[1]] == [(2, 2 + len(lines))]
    glued = f"key_{lines}"
    assert [(a, b) for _, a, b in secrets.scan_text(glued)[1]] == [(4, len(glued))]
    armoured = f"-----BEGIN PRIVATE KEY-----{line}{lines}{line}-----END PRIVATE KEY-----"
    assert secrets.scan_text('{"private": "' + armoured + '"}')[1] == [("private_key", 13, 13 + len(armoured))]
    assert not secrets.scan_text(f"{lines[:-30]} x")[1]


def test_keys_and_tokens_glued_to_what_is_in_front():
    part = lambda value: base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'s': 1})}.c2ln"
    for front in ("Authorization_", "headers_.", "eyJ_", "a.b."):
        assert secrets.scan_text(front + token)[1] == [("jwt", len(front), len(front + token))]
    assert secrets.scan_text("ab" + RSA.hex())[1][-1] == ("der_key", 2, 2 + 2 * len(RSA))


def test_stages_judge_a_few_megabytes_at_a_time(spark):
    docs = spark.range(0, 100, 1, 1).selectExpr("id AS doc_id", "repeat('ab ', 40000) AS text")
    kept = common.keep_rows(docs, "text", lambda texts: [sum(map(len, texts)) <= common.SLICE_BYTES] * len(texts))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(100))
