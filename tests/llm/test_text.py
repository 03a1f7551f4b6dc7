"""Operators on texts against brute force, and their odd cases."""

from __future__ import annotations

import base64
import json
import random
import time
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from hostpulse.llm.components import components
from hostpulse.llm.decontaminate import (
    BenchmarkIndex,
    fewest_edits,
    find_leaks,
    repetitions,
    without_leaks,
    words_of,
)
from hostpulse.llm.lines import dedup_lines
from hostpulse.llm.pieces import PieceEncoder, encode_pieces
from hostpulse.llm.secrets import scan_secrets, secrets_in
from hostpulse.llm.simhash import fingerprint, simhash_groups

DOCS = "doc_id bigint, text string"
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Lines


def deduped(rows):
    """Kept text per row, line by line."""

    def key(line):
        return "".join(
            c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r")
        )

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10 and doc_id is not None:
                holders[key(line)].add(doc_id)
    for doc_id, text in rows:
        kept = [
            line
            for line in (text or "").split("\n")
            if doc_id is None or len(holders[key(line)]) < 2 or min(holders[key(line)]) == doc_id
        ]
        lines = (text or "").count("\n") + 1
        yield doc_id, "\n".join(kept), lines, lines - len(kept)


def test_lines_against_brute_force(spark):
    random.seed(3)
    pool = [f"a line that is shared number {n}" for n in range(6)] + ["short", "", "  "]
    rows = [
        (n, "\n".join(random.choice([str.upper, str, "\t{} ".format])(random.choice(pool)) for _ in range(n % 9)))
        for n in range(60)
    ]
    rows += [
        (100, None),
        (101, ""),
        (101, ""),
        (None, pool[0]),
        (102, "İstanbul çok güzel\n\n" + pool[1]),
        (3, pool[2] + "\nanother text of the same document"),
        (103, "x" * 200_000 + "\n" + pool[3] + "\n" + pool[3]),
        (104, "\n" * 5000 + pool[4]),
    ]
    found = dedup_lines(spark.createDataFrame(rows, DOCS))
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(deduped(rows), key=repr)


def test_lines_keep_other_columns_and_replace_their_own(spark, empty):
    docs = spark.createDataFrame(
        [(1, "x", "one line of text", 7, "a"), (2, None, "One line of text ", 8, "b")],
        "doc_id bigint, lang string, text string, n_lines int, place string",
    )
    found = dedup_lines(docs)
    assert found.columns == ["doc_id", "lang", "text", "place", "n_lines", "n_dropped"]
    assert sorted(map(tuple, found.collect())) == [
        (1, "x", "one line of text", "a", 1, 0),
        (2, None, "", "b", 1, 1),
    ]
    assert dedup_lines(empty).count() == 0
    assert dedup_lines(docs, min_docs=3).agg({"n_dropped": "sum"}).first()[0] == 0


# Secrets


def length(data):
    return bytes([len(data)]) if len(data) < 128 else b"\x82" + len(data).to_bytes(2, "big")


def element(tag, *parts):
    data = b"".join(parts)
    return bytes([tag]) + length(data) + data


RSA = element(0x30, *(element(2, value) for value in [b"\0", *[bytes(range(1, 60))] * 8]))
OID = element(6, b"\x2a\x86\x48")
PKCS8 = element(0x30, element(2, b"\0"), element(0x30, OID), element(4, b"k" * 50))
TOKEN = ".".join(
    base64.urlsafe_b64encode(json.dumps(part).encode()).decode().rstrip("=")
    for part in ({"alg": "HS256"}, {"sub": "someone"})
)


def kinds(text):
    return [kind for kind, _, _ in secrets_in(text)]


def test_base_patterns():
    assert secrets_in("é PassWord = 'hunter22x'") == [("assign", 2, 23)]
    # The first match is too short, and uses up the name of the second.
    assert secrets_in("secret=token:abcdefgh") == []
    assert kinds("AKIA" + "A" * 15) == []
    assert secrets_in("xAKIA" + "A" * 16) == [("access", 1, 21)]
    assert kinds("0" * 23) == [] and secrets_in("g" + "0a" * 12) == [("hex", 1, 25)]
    assert kinds("ſecret=abcdefgh") == []
    assert secrets_in(None) == secrets_in("") == []


@pytest.mark.parametrize("key", [RSA, PKCS8])
def test_keys_are_confirmed_by_their_structure(key):
    text = base64.b64encode(key).decode()
    assert "der" in kinds("key " + text + " end") and "der" in kinds(key.hex())
    pem = f"-----BEGIN PRIVATE KEY-----\n{text[:64]}\n{text[64:]}\n-----END PRIVATE KEY-----"
    assert kinds(pem)[0] == "pem"
    broken = base64.b64encode(key[:-1]).decode()
    assert "der" not in kinds(broken) and "pem" not in kinds(pem.replace(text[64:], "AAAA"))


def test_tokens_and_openssh():
    assert "token" in kinds(f"Bearer {TOKEN}.c2ln")
    assert "token" not in kinds("aaaaaaaaaaaaaaaa.bbbbbbbb.cccc")
    fields = b"".join(len(part).to_bytes(4, "big") + part for part in (b"none", b"none", b""))
    key = base64.b64encode(b"openssh-key-v1\0" + fields + (1).to_bytes(4, "big")).decode()
    assert "openssh" in kinds(key)


OPENSSH = b"openssh-key-v1\0" + b"".join(
    len(part).to_bytes(4, "big") + part for part in (b"aes256-ctr", b"bcrypt", b"s" * 24)
) + (1).to_bytes(4, "big") + b"".join(
    len(part).to_bytes(4, "big") + part for part in (b"p" * 51, b"k" * 130)
)
HEAD, TAIL = "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"


def wrapped(key, width=64):
    text = base64.b64encode(key).decode()
    return [text[at : at + width] for at in range(0, len(text), width)]


@pytest.mark.parametrize("key", [RSA, PKCS8, OPENSSH])
@pytest.mark.parametrize("between", ["\n", "\r\n", "\\n", "\\r\\n", "\n> ", '",\n  "', '" +\n "', " "])
def test_armoured_keys_in_any_lines(key, between):
    text = "é: " + between.join([HEAD, *wrapped(key), TAIL]) + " tail"
    assert [span for span in secrets_in(text) if span[0] == "pem"] == [("pem", 3, len(text) - 5)]


@pytest.mark.parametrize("kind, key", [("der", RSA), ("der", PKCS8), ("openssh", OPENSSH)])
@pytest.mark.parametrize("between", ["\n", "\\n", "\n> "])
@pytest.mark.parametrize("tail", ["", " and so on", "\n" + "A" * 64])
def test_wrapped_keys_without_armour(kind, key, between, tail):
    text = between.join(wrapped(key))
    found = [span for span in secrets_in("x " + text + tail) if span[0] in ("der", "openssh")]
    assert found == [(kind, 2, 2 + len(text))]
    cut = between.join(wrapped(key[:-40]))
    assert "der" not in kinds(cut)


def test_hex_openssh_and_escaped_first_line():
    assert "openssh" in kinds("k " + OPENSSH.hex()) and "openssh" in kinds(OPENSSH.hex().upper())
    text = base64.b64encode(PKCS8).decode()
    assert ("der", 4, 4 + len(text)) in secrets_in("k=\\n" + text)


def test_headers_alone_confirm_nothing():
    lines = "Comment: none\n", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0A" * 16 + "\n\n"
    for headers in lines:
        assert "pem" not in kinds(f"{HEAD}\n{headers}AAAABBBB\n{TAIL}")
    body = base64.b64encode(bytes(range(48))).decode()
    assert "pem" not in kinds(f"{HEAD}\n{lines[0]}{body}\n{TAIL}")
    assert "pem" in kinds(f"{HEAD}\n{lines[1]}{body}\n{TAIL}")
    assert "pem" not in kinds(f"{HEAD}\n{lines[1]}{body[:-4]}\n{TAIL}")


def test_lines_that_look_like_keys_take_linear_time():
    begin = time.process_time()
    line = base64.b64encode(b"\x30\x82\xf0\x00\x02\x01\x00" + b"a" * 41).decode()
    assert "der" not in kinds((line + "\n") * 3_000)
    assert "pem" not in kinds(("a: " + HEAD + "\n") * 20_000)
    assert "pem" not in kinds((HEAD + "\na: b\n") * 20_000)
    assert time.process_time() - begin < 20


def test_long_runs_behind_a_key_header_take_linear_time():
    header = "-----BEGIN PRIVATE KEY-----"
    begin = time.process_time()
    assert kinds(header + " " * 1_000_000) == kinds(header + "a: \n" * 300_000) == []
    assert kinds((header + "\n") * 20_000 + "A" * 1_000_000) == []
    assert time.process_time() - begin < 20


def test_scan_odd_rows(spark, empty):
    long = "e " * 300_000 + "token=abcdefgh"
    rows = [(1, None), (None, "token=abcdefgh"), (2, ""), (2, ""), (3, long)]
    found = scan_secrets(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((len(row.findings), str(row.doc_id)) for row in found) == [
        (0, "1"),
        (0, "2"),
        (0, "2"),
        (1, "3"),
        (1, "None"),
    ]
    assert scan_secrets(empty).count() == 0


# Fingerprints


def bits_of(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    parts = [b" ".join(words[n : n + 4]) for n in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(part, 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in (None, "", " \n", "one", "One two\tthree", "É a b c d e É a b c d e", "x y " * 9000):
        assert fingerprint(text) == bits_of(text)
    assert fingerprint("\x1ca b") != fingerprint("a b")  # no white space of ASCII text


def test_groups_against_brute_force(spark):
    random.seed(5)
    words = [f"w{n}" for n in range(400)]
    rows = []
    for group in range(12):
        text = random.choices(words, k=300)
        for copy in range(8):
            rows.append((len(rows) * 3, " ".join(text)))
            if copy % 2:
                text[random.randrange(300)] = "new"
    rows += [(9000, None), (9001, ""), (9002, "alone"), (None, rows[0][1]), (0, rows[0][1])]
    found = {
        (row.doc_id, row["print"]): row.component_id
        for row in simhash_groups(spark.createDataFrame(rows, DOCS)).collect()
    }
    prints = {doc_id: fingerprint(text) for doc_id, text in rows if doc_id is not None}
    group = {doc_id: doc_id for doc_id in prints}
    while True:
        now = {
            one: min(group[two] for two in prints if (prints[one] ^ prints[two]).bit_count() <= 4)
            for one in prints
        }
        if now == group:
            break
        group = now
    assert {doc_id: root for (doc_id, _), root in found.items() if doc_id is not None} == group
    assert found[next(key for key in found if key[0] is None)] is None
    assert len(set(group.values())) < len(group) - 20


def test_one_document_with_two_texts_ties_their_groups(spark, empty):
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v"), (7, "q r s t u v")]
    found = simhash_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert {row.component_id for row in found} == {1} and len(found) == 4
    assert simhash_groups(empty).count() == 0


def test_components(spark):
    chain = [(n, n + 1) for n in range(40)] + [(100, 90), (95, 100), (7, 7), (None, 1)]
    edges = spark.createDataFrame(chain, "a bigint, b bigint")
    roots = {row.node: row.root for row in components(edges).collect()}
    assert roots == {n: 0 for n in range(41)} | {90: 90, 95: 90, 100: 90}
    assert components(edges.limit(0)).count() == 0


# Benchmark passages


def edits_brute(item, words):
    row = [0] * (len(words) + 1)
    for place, one in enumerate(item, 1):
        last, row = row, [place]
        for at, two in enumerate(words, 1):
            row.append(min(last[at] + 1, row[-1] + 1, last[at - 1] + (one != two)))
    return min(row)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(0, 3), max_size=60))
@settings(max_examples=200, deadline=None)
def test_fewest_edits(item, words):
    assert fewest_edits(item, words)[0] == edits_brute(item, words)


def benchmark_items():
    random.seed(9)
    return [
        (n, " ".join(random.choices([f"v{k}" for k in range(60)], k=random.randint(8, 60))))
        for n in range(40)
    ]


def test_leaks_against_brute_force():
    items = benchmark_items()
    index = BenchmarkIndex(items, 0.8, 5, 3, repetitions(0.5, 3, 0.98))
    split = {item_id: words_of(text) for item_id, text in items}
    vocabulary = [f"v{k}" for k in range(60)] + ["other"] * 30
    found, true = set(), set()
    for doc in range(150):
        words = random.choices(vocabulary, k=random.randint(0, 80))
        if doc % 3:
            item = list(split[doc % 40])
            for _ in range(random.randint(0, len(item) // 4)):
                place = random.randrange(len(item))
                item[place : place + random.randint(0, 1)] = ["new"] * random.randint(0, 1)
            words[len(words) // 2 : len(words) // 2] = item
        for item_id, size, edits, _ in index.search("; ".join(words).upper()):
            assert edits == edits_brute(split[item_id], words) and size == len(split[item_id])
            found.add((doc, item_id))
        true |= {
            (doc, item_id)
            for item_id, item in split.items()
            if edits_brute(item, words) <= len(item) // 5
        }
    assert found <= true and len(found) >= 0.98 * len(true) and len(true) > 60


def test_leaks_odd_rows_and_blocks(spark, empty):
    items = benchmark_items()
    table = spark.createDataFrame(
        [*items, items[0], (90, None), (91, ""), (92, "two words"), (None, "a b c d e f g h")],
        "item_id bigint, text string",
    )
    text = "before " + items[3][1] + " after"
    docs = spark.createDataFrame(
        [(1, text, "x"), (1, text, "y"), (2, None, "x"), (3, "", "x"), (None, text, "x")]
        + [(4, "two words", "x"), (5, "A, B, c d e f g h!", "x"), (6, "was " * 30_000, "x")],
        DOCS + ", item_id string",
    )
    expected = [(1, 3, 0), (4, 92, 0), (5, None, 0), (None, 3, 0)]
    for blocks in ({}, {"block_items": 10}):
        leaks = find_leaks(docs, table, **blocks).collect()
        assert sorted(((r.doc_id, r.item_id, r.edits) for r in leaks), key=repr) == expected
        rest = without_leaks(docs, table, **blocks)
        assert sorted(row.doc_id for row in rest.collect()) == [2, 3, 6]
    assert find_leaks(empty, table).count() == find_leaks(docs, table.limit(0)).count() == 0


def test_leaks_of_short_items_and_of_scripts_without_spaces(spark):
    items = [
        (1, "Two words"),
        (2, "words, two more?"),
        (3, "\u3053\u306e\u6587\u7ae0\u306f\u8a66\u9a13\u306e\u554f\u984c\u3067\u3059\u304b"),
        (4, "\u6f22\u5b57"),
        (5, "solo"),
        (6, "..."),
        (7, "TWO WORDS"),
    ]
    texts = [
        (1, "no two; WORDS two more"),
        (2, "two new words"),
        (3, "x" + items[2][1] + "y"),
        (4, "x " + items[2][1].replace("\u7ae0", "\u5b57") + " y"),
        (5, "\u5b57\u6f22 \u6f22\u3001\u5b57"),
        (6, "soloist two wordsmith"),
        (7, "a " * 20_000 + "solo"),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.edits, r.end_word) for r in find_leaks(docs, table).collect()}
    words = {key: words_of(text) for key, text in texts}
    brute = {
        (doc_id, item_id): (0, min(ends))
        for doc_id, read in words.items()
        for item_id, text in items
        if 0 < len(item := words_of(text)) < 5
        and (ends := [k + len(item) for k in range(len(read)) if read[k : k + len(item)] == item])
    }
    assert brute == {pair: at for pair, at in found.items() if pair[1] != 3}
    assert set(brute) == {(1, 1), (1, 2), (1, 7), (5, 4), (7, 5)}
    assert {pair: at[0] for pair, at in found.items() if pair[1] == 3} == {(3, 3): 0, (4, 3): 1}
    assert [row.doc_id for row in without_leaks(docs, table).orderBy("doc_id").collect()] == [2, 6]


# Pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(public_tokenizers.path(MODEL))


@given(
    st.one_of(
        st.text(max_size=60),
        st.text(alphabet=" \n\tab▁thein.éß中😀", max_size=120),
        st.lists(st.sampled_from(["the", " ", "  ", "ing", "tion", "<s>", "<0x41>", "\x00"])).map("".join),
    )
)
@settings(max_examples=600, deadline=None)
def test_pieces_like_the_library(encoder, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert encoder.encode(text).tolist() == ids
    assert encoder.decode(encoder.encode(text)) == library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 5000 + "x", "ab" * 9000 + " " * 77, "\n" * 900])
def test_long_runs(encoder, library, text):
    assert encoder.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_pieces_odd_rows(spark, empty):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b")]
    found = encode_pieces(spark.createDataFrame(rows, DOCS), MODEL).collect()
    assert sorted((str(row.doc_id), row.n_tokens, row.decoded) for row in found) == [
        ("1", 2, ""),
        ("1", 2, ""),
        ("2", 4, "a b"),
        ("2", 4, "a b"),
        ("None", 4, "a b"),
    ]
    assert found[0].ids == [1, 2] and encode_pieces(empty, MODEL).count() == 0


def test_remembered_segments_have_a_bound(encoder, monkeypatch, library):
    monkeypatch.setattr("hostpulse.llm.pieces._KEPT", 50)
    text = " ".join(f"word{n}" for n in np.random.default_rng(1).integers(0, 10_000, 400))
    assert encoder.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert len(encoder._remembered) <= max(50, 400)
