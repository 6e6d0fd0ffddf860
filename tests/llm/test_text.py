import hashlib
import importlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from classkit.llm import langid, line_templates, pii
from classkit.llm.queries import QUERIES
from tests.llm.conftest import SF, make_docs

# --- language ---------------------------------------------------------------


def plain_phrases(text, learned):
    """Greedy longest matches in segments, one byte at a time."""
    n = 0
    for start in range(0, len(text), langid.SEGMENT):
        part, at = text[start : start + langid.SEGMENT], 0
        while at < len(part):
            end = at + 1
            while end < len(part) and part[at : end + 1] in learned and part[at:end] in learned:
                end += 1
            n, at = n + 1, end
    return n


def test_cross_parsing_is_exact():
    rng = random.Random(1)
    samples = {"a": bytes(rng.choice(b"abc ") for _ in range(400)), "b": bytes(rng.choice(b"bcd") for _ in range(300))}
    parser = langid.CrossParser(samples)
    texts = ["".join(rng.choice("abcde") for _ in range(rng.choice([1, 7, 600, 1_300]))) for _ in range(12)] + ["", "é!", "..."]
    for text, rates in zip(texts, parser.rates(texts)):
        pure = langid.normalise(text)
        if not pure:
            assert rates is None
            continue
        want = [plain_phrases(pure, samples[x]) * np.log2(len(samples[x])) / len(pure) for x in ("a", "b")]
        # A segment of several texts' lanes begins with one phrase, as the plain parse does.
        assert rates == pytest.approx(want)


def test_normalise():
    assert langid.normalise("  Ab1c--É\n!") == "ab c é".encode()
    assert langid.normalise("12 . !") == b"" and langid.normalise("") == b""


def test_languages(spark, sample, odd_pairs):
    pairs = [(i, t) for i, t, _ in sample] + [(i and i + 10_000, t) for i, t in odd_pairs]
    langs = [x for _, _, x in sample] + [None] * len(odd_pairs)
    docs = make_docs(spark, pairs, langs)
    got = langid.identify(docs).collect()
    assert len(got) == len(pairs)
    letters = {(i, any(c.isalpha() for c in t or "")) for i, t in pairs}
    assert all((r["lang_pred"] == "und") == ((r["doc_id"], True) not in letters) for r in got if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = langid.keep_identified(docs, 0.02)
    assert kept.columns == docs.columns
    assert {i for i, _, _ in sample} <= {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn(spark, odd_pairs):
    got = langid.identify(make_docs(spark, odd_pairs)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)} and len(got) == len(odd_pairs)
    assert langid.identify(make_docs(spark, [])).count() == 0


def test_repeated_ids_leave_every_language_a_sample(spark):
    rows = [(1, "ab cd", "aa")] * 600 + [(2, "ef gh", "bb"), (3, "ij kl", "bb")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {x: s.count(b" ") for x, s in langid.learn(labelled).items()} == {"aa": 1, "bb": 3}


def test_registered_languages_are_right(spark, sample):
    import zlib

    lang = {i: x for i, _, x in sample}
    rows = QUERIES["op3_languages"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


# --- personal data ----------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    def fits(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return sorted((m.start(), n, m.end()) for n, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if fits(k, m[0]))


def test_base_spans_are_exact():
    rng = random.Random(7)
    alphabets = ("ab@.-", "0123. ", "+0123456789 ()-.", "4539 1488-0343+@a.", "aé1.@%+-_ ")
    for _ in range(6_000):
        text = "".join(rng.choice(rng.choice(alphabets) if rng.random() < 0.2 else alphabets[_ % 5]) for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("4539 1488 0343 6467", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "256.1.1.1 0255.1.1.1", "1" * 20_000, "a@" * 5_000, "+" * 9_000):
        assert pii.base_spans(text) == plain_spans(text)


def spelled(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_private_spans(spark, odd_pairs):
    got = pii.private_spans(make_docs(spark, odd_pairs)).select("doc_id", pii.spelled(pii.F.col("base"))).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((i, spelled(plain_spans(t or "")))) for i, t in odd_pairs)
    assert pii.private_spans(make_docs(spark, [])).count() == 0


@pytest.fixture(scope="module")
def telling():
    """A name that only ever stands beside one address, in different contexts, among common words."""
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    pairs = [(i, " ".join(words[(i + j) % 6] for j in range(4))) for i in range(40)]
    pairs += [(100 + i, f"{words[i % 6]} {words[(i * 5 + 1) % 6]} Zorblatt jo@x.org") for i in range(6)]
    return [*pairs, (200, "copy Qqqq ann@y.org"), (201, "copy Qqqq ann@y.org"), (202, "copy Qqqq ann@y.org")]


def test_terms_that_disclose(spark, telling):
    docs = make_docs(spark, telling)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.private_spans(docs).collect()}
    text = dict(telling)
    for i in range(100, 106):
        terms = [text[i][a:b] for a, k, b in spans[i] if pii.KINDS[k] == "term"]
        assert terms == ["Zorblatt"]
    # One context, however often copied, is no evidence; documents without findings have no terms.
    assert all(pii.KINDS[k] != "term" for i in range(200, 203) for _, k, _ in spans[i])
    assert all(not spans[i] for i in range(40))
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    made = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(made[i] == text[i].replace("Zorblatt", "<name>").replace("jo@x.org", "<email>") for i in range(100, 106))
    assert all(made[i] == text[i] for i in range(40))


def plain_terms(pairs, share=0.9):
    """Disclosing terms of each text, by the formulas alone."""
    texts = {t or "" for _, t in pairs}
    entities, terms = {}, {}
    for t in texts:
        spans = plain_spans(t)
        for s in spans:
            entities.setdefault(pii._entity(t, s), set()).add(t)
        for w in {m[0].lower() for m in re.finditer(r"[^\W_]+", t) if len(m[0].lower()) >= 3}:
            terms.setdefault(w, set()).add(t)
    inside = {t: {w for w, _, _ in pii._words(t, plain_spans(t))} for t in texts}
    near = {
        t: {w for w, a, b in pii._words(t, spans) if any(a - end <= 80 and start - b <= 80 for start, _, end in spans)}
        for t, spans in ((t, plain_spans(t)) for t in texts)
    }
    told = {}
    for rows in entities.values():
        p = len(rows) / len(texts)
        for w in set().union(*(inside[t] for t in rows)):
            together = sum(w in inside[t] for t in rows)
            pmi = np.log2((together + 0.5 * p) / ((len(terms[w]) + 0.5) * p))
            evidence = together >= 2 or any(w in near[t] for t in rows)
            if p < 1 and pmi >= -share * np.log2(p) and evidence:
                for t in rows:
                    if w in inside[t]:
                        told.setdefault(t, set()).add(w)
    return told


def test_terms_by_the_formulas(spark, sample, telling):
    for pairs in ([(i, t) for i, t, _ in sample] * 2, [*telling, (900, None), (None, telling[-1][1])]):
        told = plain_terms(pairs)
        rows = pii.private_spans(make_docs(spark, [(n, t) for n, (_, t) in enumerate(pairs)])).collect()
        found = 0
        for r in rows:
            text = pairs[r["doc_id"]][1] or ""
            terms = {text[a:b].lower() for a, k, b in r["spans"] if pii.KINDS[k] == "term"}
            assert terms == told.get(text, set())
            found += len(terms)
        assert found


def test_a_list_of_addresses_makes_rows_in_proportion(spark, monkeypatch):
    made = {}
    keep = pii.written
    monkeypatch.setattr(pii, "written", lambda df, name: made.setdefault(name, keep(df, name)))
    listed = " ".join(f"name{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzäöüß'[i // 100]} u{i}@x.org" for i in range(800))
    pairs = [(i, f"plain text number {'abcdefghij'[i % 10]} of {'klmnopqrst'[i // 10]}") for i in range(99)] + [(500, listed)]
    spans = {r["doc_id"]: r["spans"] for r in pii.private_spans(make_docs(spark, pairs)).collect()}
    assert sum(pii.KINDS[s["kind"]] == "term" for s in spans[500]) == 800
    assert made["pairs"].count() < 100


def test_a_rare_name_beside_a_rare_address_discloses_it(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    pairs = [(i, f"{words[i % 6]} {words[i // 6 % 6]} {words[i // 36]} plain") for i in range(150)]
    pairs += [(200, "alpha beta Quillon eve@z.org"), (201, "gamma Quillon eve@z.org omega")]  # in two documents
    pairs += [(300, "delta Wexford +44 20 7946 0958 sigma")]  # in one
    pairs += [(400 + i, f"{words[i % 6]} {words[i // 6]} Yardley sam@w.org") for i in range(20)]  # a signature
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(spark, pairs)).collect()}
    assert clean[200] == "alpha beta <name> <email>" and clean[201] == "gamma <name> <email> omega"
    assert clean[300] == "delta <name> <phone> sigma"
    assert all("<name> <email>" in clean[400 + i] for i in range(20))
    assert all(clean[i] == text for i, text in pairs[:150])


def test_a_disclosing_name_goes_from_the_whole_document(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    pairs = [(i, f"{words[i % 6]} {words[i // 6 % 6]} {words[i // 36]} plain") for i in range(150)]
    body = " ".join(words) + " plain"
    pairs += [(200, f"QUILLON\n{body * 60}\nask Quillon at eve@z.org"), (201, f"Wexford {body * 60} +44 20 7946 0958")]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(spark, pairs)).collect()}
    assert clean[200].startswith("<name>\n") and clean[200].endswith("<name> at <email>")
    # Met once, and far from the number: no evidence that it belongs to it.
    assert clean[201].startswith("Wexford alpha") and clean[201].endswith("<phone>")
    assert all(clean[i] == text for i, text in pairs[:150])


def test_evidence_is_graded_by_distance(spark):
    """One meeting near a mention is enough; far from it a term needs two texts, and rare words stay."""
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    pairs = [(i, f"{words[i % 6]} {words[i // 6 % 6]} {words[i // 36]} plain") for i in range(150)]
    far = " ".join(words * 4)  # over 80 code points
    pairs += [(200, f"Quillon eve@z.org {far} typpo"), (201, f"mistaek {far} Wexford: +44 20 7946 0958")]
    pairs += [(300, f"Yardley {far} sam@w.org"), (301, f"{far} sam@w.org {far} Yardley once")]
    pairs += [(400, "eighty " + "x" * 78 + " a@b.org"), (401, "eightyone " + "y" * 79 + " c@d.org")]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(spark, pairs)).collect()}
    assert clean[200] == f"<name> <email> {far} typpo" and clean[201] == f"mistaek {far} <name>: <phone>"
    assert clean[300] == f"<name> {far} <email>" and clean[301] == f"{far} <email> {far} <name> once"
    assert clean[400].startswith("<term> ") and clean[401].startswith("eightyone ")
    assert all(clean[i] == text for i, text in pairs[:150])


def test_sanitised_nulls_stay(spark, odd_pairs):
    rows = pii.sanitise(make_docs(spark, odd_pairs)).collect()
    assert len(rows) == len(odd_pairs) and sum(r["text"] is None for r in rows) == 2
    assert all("a@b.co" not in (r["text"] or "") for r in rows)


def test_registered_personal_data(spark, sample):
    rows = {r["doc_id"]: r for r in QUERIES["op8_personal_data"](spark, SF).collect()}
    assert len(rows) == len(sample)
    for i, t, _ in sample:
        base = plain_spans(t)
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [sum(s[1] == n for s in base) for n in range(4)]
        assert rows[i]["base_sha256"] == hashlib.sha256(spelled(base).encode()).hexdigest()


# --- recurring lines --------------------------------------------------------


# Scripts without spaces, as the operator lists them in UTF-8.
UNSPACED = "[\u0e00-\u0eff\u1000-\u10bf\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U00033fff]"


def plain_tokens(line):
    line = re.sub(UNSPACED + "{6,}", lambda run: " " + "".join(c + " " for c in run[0]), line)
    return tuple(re.sub(rb"\S*[0-9]\S*", b"<*>", line.encode()).split())


def plain_lines(pairs, min_docs=3, share=0.7, depth=3, min_tokens=3, long_tokens=50, percent=10):
    """Kept lines per row, by the definition: counts over different lines of each row."""
    parsed = {}
    for n, (_, text) in enumerate(pairs):
        for line in (text or "").split("\n"):
            tokens = plain_tokens(line)
            if len(tokens) >= min_tokens:
                parsed.setdefault(n, {})[line] = tokens
    docs_of = {}
    for n, lines in parsed.items():
        for tokens in lines.values():
            docs_of.setdefault(tokens, set()).add(n)
    support, total = {}, {}
    for tokens, rows in docs_of.items():
        leaf = (len(tokens), tokens[:depth])
        total[leaf] = total.get(leaf, 0) + len(rows)
        for place, token in enumerate(tokens):
            support[leaf, place, token] = support.get((leaf, place, token), 0) + len(rows)
    homes, names = {}, {}
    order = lambda n: (pairs[n][0] is None, pairs[n][0] or 0, n)
    for tokens, rows in docs_of.items():
        leaf = (len(tokens), tokens[:depth])
        least = min(2, min_docs) if len(tokens) >= long_tokens else min_docs
        if len(rows) >= least:
            homes[tokens] = (set(rows), least)
            names.setdefault(tokens, []).append(tokens)
        counts = [support[leaf, p, t] for p, t in enumerate(tokens)]
        constant = tuple((p, t) for (p, t), n in zip(enumerate(tokens), counts) if n >= min_docs and 100 * n >= percent * total[leaf])
        if len(constant) >= share * len(tokens):
            homes.setdefault((leaf, constant), (set(), min_docs))[0].update(rows)
            names.setdefault(tokens, []).append((leaf, constant))
    home = {name: min(rows, key=order) for name, (rows, least) in homes.items() if len(rows) >= least}
    out = []
    for n, (i, text) in enumerate(pairs):
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not any(home.get(name, n) != n for name in names.get(parsed.get(n, {}).get(x), ()))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def drop_lines(spark, pairs, path):
    make_docs(spark, pairs).drop("n_lines").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    got = line_templates.drop_recurring_lines(docs, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    return sorted(str(tuple(r)) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect())


def test_recurring_lines(spark, odd_pairs, tmp_path):
    rng = random.Random(9)
    pairs = [(i, f"unique {i}a text of {rng.choice('xyz')}\nUser {i * 7} logged in at host h{i}\nAll rights reserved.\nof") for i in range(12)]
    pairs += [(50 + i, f"the same five words {rng.choice(['here', 'there', f'x{i}z', 'q' + 'abc'[i % 3]])}\n\nlast") for i in range(20)]
    pairs += [(80, "passage " + "word " * 60), (81, "passage " + "word " * 60 + "\r"), (None, "passage " + "word " * 60), *odd_pairs]
    want = plain_lines(pairs)
    assert drop_lines(spark, pairs, str(tmp_path / "docs")) == sorted(map(str, want))
    assert sum(w[3] for w in want) > 20
    assert drop_lines(spark, [], str(tmp_path / "none")) == []


def test_long_lines_of_two_documents_recur(spark):
    passage, short = " ".join(f"word{'abcdefgh'[i % 8]}" for i in range(60)), "a line of a few words"
    pairs = [(1, f"one\n{passage}\n{short}"), (2, f"two\n{passage}\n{short}"), (3, "three")]
    got = line_templates.drop_recurring_lines(make_docs(spark, pairs).drop("n_lines"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: pairs[0][1], 2: f"two\n{short}", 3: "three"}


def test_lines_without_spaces_recur(spark):
    lines = ["本网站的所有内容均受版权保护未经许可不得转载", "無断転載を禁じます詳しくは利用規約をご覧ください", "สงวนลิขสิทธิ์ห้ามทำซ้ำหรือเผยแพร่"]
    pairs = [(i, "\n".join([*lines, f"page{'abcd'[i]}"])) for i in range(4)]
    got = line_templates.drop_recurring_lines(make_docs(spark, pairs).drop("n_lines"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: t if not i else f"page{'abcd'[i]}" for i, t in pairs}


def test_fields_of_common_values_are_fields(spark):
    rng = random.Random(5)
    line = "dear reader your order from {} was sent to {} and will be paid by {} before the month ends as agreed"
    field = lambda kind: f"{kind}{'abcdefghijklmnopqrstuvwxyzäöüß'[rng.randrange(30)]}"
    lines = {line.format(field("shop"), field("town"), field("bank")) for _ in range(700)}
    pairs = list(enumerate(sorted(lines)[:600]))
    got = line_templates.drop_recurring_lines(make_docs(spark, pairs).drop("n_lines"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: "" if i else t for i, t in pairs}


def test_unique_fields_of_many_documents(spark):
    name = "translate(cast(id * {} % 1000003 as string), '0123456789', 'abcdefghij')"
    text = f"concat('the account of ', {name.format(7919)}, ' was opened for ', {name.format(104729)}, ' on the usual terms and conditions')"
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.expr(text).alias("text"))
    assert docs.select("text").distinct().count() == 60_000
    kept = line_templates.drop_recurring_lines(docs).where("text != ''").collect()
    assert [r["doc_id"] for r in kept] == [0]


def test_rows_of_multiplied_tables_are_documents_of_their_own(spark, tmp_path, sample):
    line = "a line that every document has"
    make_docs(spark, [(i, f"{line}\n{t}") for i, t, _ in sample[:20]]).drop("n_lines").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    twice = stored.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    joined = stored.join(spark.createDataFrame([(i, c) for i, _, _ in sample[:20] for c in (1, 2)], "doc_id long, copy int"), "doc_id")
    for docs in (twice, joined):
        got = line_templates.drop_recurring_lines(docs).collect()
        assert len(got) == 40 and sum((r["text"] or "").startswith(line) for r in got) == 1


def test_registered_recurring_lines(spark, sample):
    rows = {r["doc_id"]: r for r in QUERIES["op9_recurring_lines"](spark, SF).collect()}
    for i, text, n, dropped in plain_lines([(i, t) for i, t, _ in sample]):
        assert (rows[i]["n_lines"], rows[i]["n_dropped"], rows[i]["n_chars"]) == (n, dropped, len(text))
        assert rows[i]["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- pipeline ---------------------------------------------------------------


def test_pipeline(spark, sample, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    assert [name for name, _ in pipeline.STAGES] == ["language", "recurring_lines", "near_duplicates", "personal_data", "packing"]
    docs = pipeline.documents(spark, SF)
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    ids = lambda name: [r["doc_id"] for r in seen[name]]
    assert sorted(ids("language")) == [i for i, _, _ in sample]
    text = {r["doc_id"]: r["text"] for r in seen["recurring_lines"]}
    order = [(r["doc_id"], r["text"]) for r in seen["language"]]
    assert text == {i: t for i, t, _, _ in plain_lines(order)}
    from tests.llm.test_dedup import expected_near

    roots = expected_near([(i, text[i]) for i in sorted(text)])[1]
    assert sorted(ids("near_duplicates")) == sorted({sorted(text)[r] for r in roots})
    for r in seen["personal_data"]:
        assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
    run = pipeline.run(spark, SF)
    same = lambda rows: sorted(tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32")) for r in rows)
    assert {r[0] for r in same(run.collect())} == {r[0] for r in same(seen["packing"])} == set(ids("personal_data"))


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_take_odd_documents(spark, odd_pairs, empty):
    """Nulls, empty, long and repeated texts, null and repeated ids, clashing names, no documents at all."""
    pipeline = importlib.import_module("corpus_pipeline")
    pairs = [] if empty else [*odd_pairs, *[(400 + i, "plain words of a language that can be told apart " * 3) for i in range(3)]]
    docs = make_docs(spark, pairs, ["en"] * len(pairs))
    ids = lambda df: sorted((str(r["doc_id"]) for r in df.select("doc_id").collect()))
    given = ids(docs)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = ids(out)
        assert kept == given if name in ("recurring_lines", "personal_data") else set(kept) <= set(given), name
    pieces = pipeline.packing(spark, docs, SF).groupBy("doc_id").count()
    assert set(ids(pieces)) == set(given)
