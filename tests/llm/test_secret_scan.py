import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cloudtally.llm import secret_scan
from cloudtally.llm.queries import op4_secret_scan

SF_DIR = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    """The contract's patterns on code points, failing matches dropped."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    names = ["assign", "access", "hex"]
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))
    return (*[sum(k == i for _, k, _ in found) for i in range(3)], hashlib.sha256(joined.encode()).hexdigest(), joined)


PARTS = ["token", "SECRET", "apı_key", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef",
         "é", "😀", "\n", "toKen", "ſecret", "abcdefg", "-", "x"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_patterns(text):
    raw = text.encode()
    spans = secret_scan.code_points(raw, secret_scan.base_spans(raw))
    names = secret_scan.KINDS
    assert ",".join(f"{names[k]}:{a}:{b}" for a, b, k in spans) == brute(text)[4]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op4_secret_scan(spark, SF_DIR).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        assert tuple(got[i])[1:5] == brute(text)[:4]
        spans = [s for s in got[i].spans.split(",") if s and not s.startswith("random")]
        assert ",".join(spans) == brute(text)[4]
    assert sum(r.n_hex for r in got.values()) > 0


def test_models_on_held_out_strings(spark):
    """Trained on a corpus with hex secrets, tried on new random strings and on identifiers."""
    rng = random.Random(4)
    syllables = ["con", "fig", "get", "user", "name", "path", "data", "load", "er", "ing", "tion", "un", "der", "max"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    name = lambda: rng.choice(["_", "-", "/"]).join(word(rng.randint(2, 4)) for _ in range(4)) + rng.choice(["", "2", "_v12", "/2024"])
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [f"{word(2)} {name()} {word(3)} " * 20 for _ in range(60)]
    texts += [f'token = "{draw("0123456789abcdef", 40)}" {name()}' for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    models = secret_scan.trained(secret_scan.pair_counts(df))
    names = [n for n in (name() for _ in range(400)) if len(n) >= 20]
    secrets = [draw(mixed, rng.randint(24, 60)) for _ in range(300)] + [draw("0123456789ABCDEF", 32) for _ in range(100)]
    hit = lambda s: bool(secret_scan.random_spans(f"x {s} y".encode(), [], models))
    assert sum(map(hit, secrets)) >= 0.97 * len(secrets)
    assert sum(map(hit, names)) <= 0.01 * len(names)
    rows = secret_scan.scanned(df).collect()
    assert all([s.kind for s in r.spans] == (["assign", "hex"] if r.row.doc_id >= 60 else []) for r in rows)


WORDS = """kubernetes terraform warehouse ledger voucher tariff shipment freight courier pallet harvest orchard turbine
battery charger pavement bicycle commuter ferry glacier meadow thunder lantern copper velvet saddle harbour anchor
Rechnungsstelle Zahlungsziel entrepot livraison almacen reparto magazzino spedizione""".split()


def test_labelled_models():
    """Strings of every alphabet, without digits too, and identifiers of names that no sample has."""
    rng, names = random.Random(8), set(secret_scan.identifier_names())
    assert not names & set(WORDS)
    models = secret_scan.trained(secret_scan.labelled_counts())
    hit = lambda s: secret_scan.random_spans(f"x {s} y".encode(), [], models) == [(2, 2 + len(s), 3)]
    for letters in secret_scan.RANDOM_ALPHABETS:
        drawn = ["".join(rng.choices(letters, k=40)) for _ in range(300)]
        assert sum(map(hit, drawn)) >= 0.93 * len(drawn), letters
    held = [n for n in (secret_scan.identifier(WORDS, rng) for _ in range(6000)) if len(n) >= 20]
    assert len(held) > 1500 and any(c.isdigit() for n in held for c in n)
    assert sum(map(hit, held)) <= 0.01 * len(held)
    assert not any(map(hit, ["-" * 60, "=" * 40, "0" * 30, *[c * 51 for c in "aeiouxzQ7"]]))


def test_strings_without_digits_are_found(spark, docs):
    rng = random.Random(3)
    keys = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=48)) for _ in range(40)]
    rows = secret_scan.scanned(docs([f"the key is {k} said the warehouse_manager-2024 twice" for k in keys])).collect()
    found = [[(s.kind, s.begin, s.end) for s in r.spans] for r in rows]
    assert sum(f == [("random", 11, 59)] for f in found) >= 36 and all(len(f) <= 1 for f in found)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = secret_scan.scanned(odd_docs).collect()
    assert len(rows) == odd_docs.count() and not any(r.spans for r in rows)
    assert secret_scan.scanned(no_docs).count() == 0
