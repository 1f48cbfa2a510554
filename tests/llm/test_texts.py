from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_helpers import documents, prose, rows_of
from martwright.llm import chat, packing, secrets, template, tokens, toxicity, urls
from martwright.llm.queries import op2_chat_format

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# ---- secrets -----------------------------------------------------------------------------------------------------

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _base_spans(text):
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, e, secrets.NAMES[k]) for s, k, e in sorted(found)]


def _checked(prefix, body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = secrets._BASE62[d] + digits
    return prefix + body + digits


def _scanned(text):
    raw = text.encode()
    return secrets.in_characters(raw, secrets.Scanner().spans(raw))


def test_base_spans_like_a_full_scan():
    rng = random.Random(2)
    parts = ["password", "PassWD", "sec", "ret", "token", "api_key", "apikey", "=", ": ", '"', "'", " ", "AKIA", "AKIAAKIA", "abcdef01" * 4]
    parts += ["a1b2", "Zz9+/", "\u00e9", "\u212a", "\n", "0" * 31, "f", "g", "X" * 12, "tokentoken=", "\u0130", "\U0001f600"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in _scanned(text) if s[2] in secrets.BASE] == _base_spans(text), text


def test_checksums_decide():
    good = _checked("ghp_", "A" * 30)
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    assert [s[2] for s in _scanned(f"\u00e9 {good} {good[:-1]}!")] == ["github"]
    assert _scanned(good[:-1] + ("0" if good[-1] != "0" else "1")) == []
    assert [s[2] for s in _scanned(_checked("npm_", "Z" * 30))] == ["npm"]
    assert [s[2] for s in _scanned(f"{head}.abc.def")] == ["jwt"] and _scanned("eyJabc.abc.def") == []


def test_secret_rows(spark):
    rows = [(1, None), (1, ""), (None, "token=12345678"), (2, "x" * 200_000 + " password: hunter2hunter2"), (2, "\u00e9 token=12345678")]
    got = {(r.doc_id, r.s) for r in secrets.secret_spans(documents(spark, *rows)).select("doc_id", secrets.listed(F.col("spans")).alias("s")).collect()}
    assert got == {(1, ""), (None, "assign:0:14"), (2, "assign:200001:200025"), (2, "assign:2:16")}
    assert secrets.secret_spans(documents(spark, "x").limit(0)).count() == 0


# ---- chat --------------------------------------------------------------------------------------------------------


def _render(source, **values):
    messages = values.pop("messages", [])
    return list(template.Template(source, ("###",)).render(messages, **values))


def test_templates():
    say = [{"role": "a", "text": "x"}, {"role": "b", "text": "y###"}]
    loop = "{% for m in messages %}{% if loop.first %}<{% elif loop.last %}>{% endif %}{{ m.text | escape }}{% endfor %}"
    assert "".join(t for t, _ in _render(loop, messages=say)) == "<x>y\\###"
    assert _render("{% generation %}{{ x }}{% endgeneration %}-", x="q") == [("q", True), ("-", False)]
    assert "".join(t for t, _ in _render("{{ a ~ 'b' == 'ab' and not false }}{{ a.role }}{{ none }}", a="a")) == "true"
    nested = "{% for a in messages %}{% for b in messages %}{{ a.text }}{{ b.role }} {% endfor %}{% endfor %}"
    assert "".join(t for t, _ in _render(nested, messages=say)) == "xa xb y###a y###b "
    assert _render("{% for m in messages %}x{% endfor %}") == []


def test_constants_are_folded():
    folded = template.Template("a{% set s = 'b' ~ 'c' %}{{ s | upper }}{% if s == 'bc' %}d{% else %}e{% endif %}{% if false %}f{% endif %}").tree
    assert folded == [("out", ("const", "aBCd"))]
    kept = template.Template("{% set s = 'x' %}{% for m in messages %}{{ s }}{% set s = m.text %}{% endfor %}{{ s }}")
    assert "".join(t for t, _ in kept.render([{"text": "1"}, {"text": "2"}])) == "x12"


@pytest.mark.parametrize("bad", ["{% for x in y %}", "{{ f(x) }}", "{{ x | exec }}", "{% import os %}", "{{ a.__class__ b }}", "{% if x %}", "{{ 'a }}"])
def test_what_is_not_in_the_language(bad):
    with pytest.raises(template.TemplateError):
        template.Template(bad)


def test_fields_are_no_attributes():
    assert _render("{{ m.__class__ }}", m="text") == [("", False)]


def test_conversations_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 200)
    rng = random.Random(4)
    pieces = ["\\", "###", "</turn>", ":", "\n", "#", "<", "</", "x", "\u00e9", "### user: ", "\\n"]
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "a:b", ""]), text()) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(50, None, None, None), (50, 1, "assistant", None), (51, 1, "user", "b"), (51, 1, "user", "a"), (51, 1, "user", "a")]
    rows += [(None, 1, "assistant", "n"), (52, 1, "assistant", "long " * 50_000), (53, 5, "user", "later"), (53, -5, "assistant", "first")]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")
    formatted = chat.format_conversations(table)
    by_id = {}
    for r in sorted(formatted.collect(), key=lambda r: (repr(r.conv_id), r.part)):
        turns, loss = by_id.setdefault(r.conv_id, ([], []))
        turns += chat.read_turns(r.text)
        loss += [template.Escaper.undo(r.text[s.start : s.end]) for s in r.loss]
    wanted = {}
    for c, t, role, said in sorted(rows, key=lambda r: (repr(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(c, []).append((role or "", said or ""))
    assert {c: t for c, (t, _) in by_id.items()} == wanted
    assert {c: "".join(x) for c, (_, x) in by_id.items()} == {c: "".join(s for r, s in t if r == "assistant") for c, t in wanted.items()}
    for r in chat.read_back(formatted).collect():
        turns = wanted[r.conv_id]
        loss = "".join(s for role, s in turns if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss)) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_long_conversations_are_cut_behind_whole_turns(spark):
    hostile = "x" * chat.PART_CHARS + "</turn>\n"
    said = [("user", hostile), ("assistant", hostile), ("user", "\\</turn>\n"), ("assistant", "end\\")]
    table = spark.createDataFrame([(1, t, *s) for t, s in enumerate(said)], "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_conversations(table)
    parts = formatted.orderBy("part").collect()
    assert [list(chat.read_turns(r.text)) for r in parts] == [said[:1], said[1:2], said[2:]]
    [read] = chat.read_back(formatted).collect()
    assert read.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
    assert read.loss_sha256 == hashlib.sha256("".join(s for r, s in said if r == "assistant").encode()).hexdigest()


@pytest.mark.parametrize("source", [chat.TURNS, "<{% for m in messages %}{% if loop.first %}[{% endif %}{{ m.text }}{% if loop.last %}]{% endif %}{% endfor %}>"])
def test_a_hot_conversation_is_rendered_by_many_tasks(spark, monkeypatch, source):
    rows = [(1, t, "assistant" if t % 2 else "user", f"</turn> {t}") for t in range(900)] + [(1, None, "user", "nothing")]
    rows += [(c, t, "assistant", "### x") for c in range(2, 40) for t in range(3)]
    rows += [(None, 7, "user", str(k)) for k in range(60)] + [(90, None, "user", str(k)) for k in range(60)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    whole = chat.format_conversations(table, source)
    assert not whole.where("split").count()
    digests = rows_of(chat.read_back(whole), "*") if source == chat.TURNS else None
    monkeypatch.setattr(chat, "HOT_TURNS", 50)
    monkeypatch.setattr(chat, "PART_CHARS", 100)
    parts = chat.format_conversations(table, source)
    # One turn number cannot be cut: only conversation 1 is.
    assert {r.conv_id for r in parts.where("split").select("conv_id").distinct().collect()} == {1}
    assert parts.where("conv_id = 1").selectExpr(f"part div {chat.STRETCH_PARTS}").distinct().count() > 100

    def joined(df):
        texts = {}
        for r in sorted(df.collect(), key=lambda r: r.part):
            texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
        return texts

    assert joined(parts) == joined(whole)
    if digests:
        assert rows_of(chat.read_back(parts), "*") == digests


def test_which_templates_can_be_cut():
    cut = lambda source: template.Template(source).by_turn
    assert cut("{% set a = 'x' %}{% for m in messages %}{{ a }}{{ m.text }}{% endfor %}{{ a }}")
    assert not cut("{% for m in messages %}{% set a = m.text %}{{ a }}{% endfor %}")
    assert not cut("{% for m in messages %}{% for n in messages %}{{ n.text }}{% endfor %}{% endfor %}")
    assert not cut("{{ messages }}")


# ---- packing -----------------------------------------------------------------------------------------------------


def test_ids_are_the_tokenizers():
    texts = ["", " ", "Don't it's 'S", "a  b\n\nc", "<|endoftext|>x", "\u00e9\u00c9\u00df\u1e9e \u0130x", "\ufb01 \u00e1 a\u0301", "1234 \u65e5\u672c", "!'s ...", "\x1c a\x7fb"]
    texts += ["\u00aa\u00ba\u00b5 \u00d7\u00f7", "\u03a3\u03c2 \u0391\u03a3", "\x00 \t", prose(1, 300), prose(2, 50).title()]
    encoder = tokens.Encoder(TOKENIZER)
    assert encoder.words is not None
    got = [ids.tolist() for ids in encoder.encode(texts)]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    other = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.words is None and other.encode(["a b"])[0].tolist() == other.tokenizer.encode("a b").ids


def _packed(rows, docs, limits):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r[5], []).append(r)
        by_doc.setdefault(r[0], []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r[6])
        total = sum(r[2] for r in pieces)
        assert [r[6] for r in pieces] == [sum(x[2] for x in pieces[:k]) for k in range(len(pieces))]
        assert total == limits.tokens or total & (total - 1) == 0
        assert len(pieces) <= limits.segments and sum(r[4] for r in pieces) <= limits.loss_tokens and total <= limits.tokens
    for doc_id, (ids, loss) in docs.items():
        pieces = sorted(by_doc[doc_id], key=lambda r: r[1])
        assert b"".join(r[7] for r in pieces) == ids.tobytes() and {r[3] for r in pieces} == {len(ids)}
        assert [r[1] for r in pieces] == [sum(x[2] for x in pieces[:k]) for k in range(len(pieces))]
        assert sum(r[4] for r in pieces) == int(loss.sum())


@pytest.mark.parametrize("limits", [packing.Limits(64, 5, 64), packing.Limits(64, 5, 20), packing.Limits(64, 64, 64), packing.Limits(50, 1, 7)])
def test_no_limit_is_broken_and_no_id_lost(limits):
    rng = np.random.default_rng(1)
    packer, docs = packing.Packer(limits), {}
    for k in range(900):
        ids = rng.integers(0, 99, int(rng.choice([1, 2, 5, 30, 64, 65, 300]))).astype("<u4")
        loss = rng.random(len(ids)) < rng.choice([0.0, 0.3, 1.0])
        docs[k] = (ids, loss)
        packer.add(k, ids, loss)
    packer.finish()
    _packed(packer.rows, docs, limits)


def test_documents_are_packed_whole(spark):
    rows = [(1, None), (2, ""), (3, prose(1, 3000)), (4, "a b"), (4, "a b"), (None, "x"), (5, "word " * 20_000)]
    pieces = packing.pack(documents(spark, *rows).repartition(2), TOKENIZER).collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    wanted = sum(len(encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in pieces) == wanted
    assert {r.doc_tokens for r in pieces if r.doc_id in (1, 2)} == {1}
    fills = {}
    for r in pieces:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in fills.values())
    assert packing.pack(documents(spark, "x").limit(0), TOKENIZER).count() == 0


def test_prompts_bear_no_loss(spark):
    table = documents(spark, (1, "say this")).withColumn("asked", F.lit("a question of some length"))
    (piece,) = [r for r in packing.pack(table, TOKENIZER, packing.Limits(64, 4, 64), prompt="asked").collect() if r.start == 0]
    encode = Tokenizer.from_file(TOKENIZER).encode
    assert piece.doc_tokens == len(encode("a question of some length").ids) + len(encode("say this").ids) + 1
    assert sum(r.loss_tokens for r in packing.pack(table, TOKENIZER, prompt="asked").collect()) == len(encode("say this").ids) + 1


# ---- urls --------------------------------------------------------------------------------------------------------


def _plain_url(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(str(r)), default=None)
    return host, path, best and str(best), best and best.verdict


URLS = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://a.Example.ORG/es/1?q#f", "https://example.org/en/1", "http://example.org/en/2"]
URLS += ["http://x.com/fr/", "http://com/de/x", "http://notorg/", "http://x.org?/es/", "a://b://c.org/x", "http://x.com/de", "http://\u00c9.org/\n", "x://y.net/" + "z" * 50_000]


def test_hosts_paths_and_rules(spark):
    table = spark.createDataFrame([(k % 9, u, "h") for k, u in enumerate(URLS)], "page_id bigint, url string, host string")
    got = rows_of(urls.judge_urls(table), "page_id", "host", "path", "rule")
    assert got == sorted([(k % 9, *_plain_url(u)[:3]) for k, u in enumerate(URLS)], key=repr)
    for r in urls.judge_urls(table).collect():
        assert r.verdict in ("allow", "block") and (r.rule is None or r.verdict == {str(x): x.verdict for x in urls.RULES}[r.rule])
    none = urls.judge_urls(table.filter("url is null"))
    assert [(r.host, r.path, r.rule, r.verdict) for r in none.collect()] == [("", "", None, "allow")]
    assert urls.judge_urls(table.limit(0)).count() == 0


def test_the_model_learns_from_labels(spark):
    rng = random.Random(1)
    name = lambda kind: f"http://{kind}{rng.randrange(999)}.{rng.choice(['net', 'info'])}/{rng.choice(['a', 'b'])}/{rng.randrange(9999)}"
    kinds = [("allow", "library"), ("block", "casino")]
    labels = spark.createDataFrame([(name(k), v) for v, k in kinds * 150], "url string, verdict string")
    pages = spark.createDataFrame([(n, name(k), v) for n, (v, k) in enumerate(kinds * 100)], "page_id bigint, url string, wanted string")
    got = urls.judge_urls(pages, (), labels).join(pages.select("page_id", "wanted"), "page_id")
    assert got.filter("verdict = wanted").count() >= 195
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_repeated_urls_count_once_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(urls, "SAMPLE", 40)
    good = [f"http://site{k}.net/{p}/{k}" for k in range(10) for p in ("news", "blog", "docs", "wiki")]
    bad = [f"http://site{k}.net/{p}/{k}" for k in range(10) for p in ("spam", "xxx", "casino", "pills")]
    labels = spark.createDataFrame([(u, "allow") for u in good] + [(u, "block") for u in bad], "url string, verdict string")
    pages = spark.createDataFrame(list(enumerate(u.replace("site", "host") for u in good + bad)), "page_id bigint, url string")
    often = labels.crossJoin(spark.range(60)).select("url", "verdict")
    wanted = [(k, "allow" if k < len(good) else "block") for k in range(len(good + bad))]
    for table in (labels, often):
        assert rows_of(urls.judge_urls(pages, labels=table), "page_id", "verdict") == sorted(wanted, key=repr)


# ---- toxicity ----------------------------------------------------------------------------------------------------


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def test_automata_accept_what_is_close():
    rng = random.Random(7)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(2))
        for edits in (0, 1, 2):
            automaton = toxicity.Levenshtein(a, edits)
            state = automaton.start()
            for char in b:
                state = automaton.step(state, char)
            assert automaton.accepts(state) == (_distance(a, b) <= edits)


def test_lexicons_find_misspelled_terms():
    rng = random.Random(8)
    terms = {"".join(rng.choice("abcd") for _ in range(rng.randint(3, 8))): 1.0 for _ in range(60)}
    lexicon = toxicity.Lexicon(terms, frozenset({"abcda"}))
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(2, 9))) for _ in range(2000)} | {"abcda"}
    got = lexicon.look_up(words)
    for w in words:
        close = sorted(t for t in terms if len(t) >= 4 and _distance(t, w) <= 1)
        wanted = (w, True) if w in terms else (close[0], False) if close and w != "abcda" else None
        assert got.get(w) == wanted, w


def test_quotation_counts_apart():
    lexicon = toxicity.Lexicon({"moron": 2.0})
    plain, said = toxicity.features("you moron", lexicon), toxicity.features('he said "moron" to me', lexicon)
    assert plain[0] > 0 == plain[1] and said[1] > 0 == said[0]
    assert toxicity.features(None, lexicon) == toxicity.features("\n", lexicon) == [0.0] * toxicity.N_FEATURES
    assert toxicity.features("m\u00f6ron MORON, morron", lexicon)[2] > 0


def _toxic_corpus(spark, n):
    rng = random.Random(3)
    bad = ["zaggle", "brontic", "mulvane", "quorple"]
    rows, labels = [], []
    for k in range(n):
        w = prose(k, 60).split()
        if k % 5 == 0:
            for _ in range(4):
                term = rng.choice(bad)
                at = rng.randrange(len(term))
                w[rng.randrange(len(w))] = term[:at] + rng.choice("xyz") + term[at + 1 :] if rng.random() < 0.2 else term
        rows.append((k, " ".join(w)))
        labels.append((k, int(k % 5 == 0)))
    return documents(spark, *rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = _toxic_corpus(spark, 600)
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.97
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.score_toxicity(docs, flipped), "doc_id", "score") == sorted([(r.doc_id, r.score) for r in got], key=repr)


def test_odd_tables_are_scored(spark):
    docs = documents(spark, (1, None), (1, ""), (None, "x"), (2, "a b " * 50_000))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    for labels in (none, spark.createDataFrame([(1, None), (None, 1), (1, 0), (77, 1)], "doc_id bigint, toxic int")):
        rows = toxicity.score_toxicity(docs, labels).collect()
        assert len(rows) == 4 and len({r.score for r in rows}) == 1
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0


def _plain_tokens(lower):
    """(start, end) of runs of letters, and of two or more such runs with one other character between neighbours."""
    runs, at = [], 0
    while at < len(lower):
        end = at
        while end < len(lower) and lower[end].isalpha():
            end += 1
        if end > at:
            runs.append((at, end))
        at = max(end, at + 1)
    joined, group = [], []
    for run in [*runs, (10**9, 0)]:
        if group and not (run[0] == group[-1][1] + 1 and not lower[group[-1][1]].isspace()):
            if len(group) > 1:
                joined.append((group[0][0], group[-1][1]))
            group = []
        group.append(run)
    return runs, joined


def _plain_features(text, terms, harmless):
    lower = (text or "").lower()
    runs, joined = _plain_tokens(lower)
    abuse = quotation = misspelled = 0.0
    count, met = 0, set()
    for a, b in runs + joined:
        word = lower[a:b]
        term = word if word in terms else None
        if term is None and word not in harmless:
            term = min((t for t in terms if len(t) >= 4 and _distance(word, t) <= 1), default=None)
        if term is None:
            continue
        before, after = lower[max(0, a - 60) : a].split("\n")[-1], lower[b : b + 60].split("\n")[0]
        share = 0.5 * any(q in before for q in toxicity.QUOTES) + 0.5 * any(q in after for q in toxicity.QUOTES)
        if word == term:
            abuse, quotation = abuse + terms[term] * (1 - share), quotation + terms[term] * share
        else:
            misspelled += terms[term] * (1 - share)
        met.add(term)
        count += 1
    per_hundred = 100 * count / len(runs) if runs else 0.0
    return [math.log1p(x) for x in (abuse, quotation, misspelled, len(met), per_hundred)]


def test_features_like_plain_search():
    rng = random.Random(6)
    terms = {"scum": 2.0, "moron": 3.0, "idiot": 1.5, "id-iot": 2.5, "ass": 1.0}
    harmless = frozenset({"spam", "moro"})
    lexicon = toxicity.Lexicon(terms, harmless)
    pieces = [*terms, "spam", "moro", "scvm", "s.cum", "id1ot", "m*ron", "idi0t,", "mor-on", "as", "x1y", "well-known", "don't", "ÜBER", "a_b", "9"]
    for k in range(400):
        words = [rng.choice(pieces) for _ in range(rng.randint(0, 25))]
        text = "".join(w + rng.choice([" ", "\n", ' "', '" ', ", ", "  "]) for w in words)
        assert toxicity.features(text, lexicon) == pytest.approx(_plain_features(text, terms, harmless)), text
    for hidden in ("you id1ot", "you m*ron", "scm", "SCUUM", "s-cum"):
        assert toxicity.features(hidden, lexicon)[2] > 0
    long_word = "x" * 100_000
    assert toxicity.features(long_word + " moron", lexicon)[0] > 0


def test_model_like_plain_counts(spark):
    docs, labels = _toxic_corpus(spark, 300)
    toxicity.ship(spark)
    model = toxicity.learn(docs, labels)
    held = {i for (i,) in rows_of(docs, "doc_id") if zlib.crc32(str(i).encode()) % 5 == 0}
    wanted = dict(rows_of(labels, "doc_id", "toxic"))
    train = [(text, wanted[i]) for i, text in rows_of(docs, "doc_id", "text") if i in wanted and i not in held]
    sizes = [sum(1 for _, t in train if t == k) for k in (0, 1)]
    seen: dict[str, list[int]] = {}
    for text, t in train:
        lower = (text or "").lower()
        for word in {lower[a:b] for spans in _plain_tokens(lower) for a, b in spans}:
            seen.setdefault(word, [0, 0])[t] += 1
    share = sizes[1] / sum(sizes)
    terms = {}
    for word, (good, bad) in seen.items():
        n, ratio = good + bad, ((bad + 0.5) / (sizes[1] + 1)) / ((good + 0.5) / (sizes[0] + 1))
        odds = bad / n
        evidence = bad * math.log(odds / share) if bad else 0.0
        evidence += good * math.log((1 - odds) / (1 - share)) if good else 0.0
        if bad >= 3 and ratio >= 8 and evidence >= math.log(max(len(seen), 2)):
            terms[word] = math.log(ratio)
    assert model.terms == pytest.approx(terms) and terms
    near = {w for w, (good, bad) in seen.items() if good > 0 and good >= bad and w not in terms and any(len(t) >= 4 and _distance(w, t) <= 1 for t in terms)}
    assert model.harmless == near
    rows = np.array([_plain_features(text, terms, near) for text, _ in train])
    design, y = np.column_stack((np.ones(len(rows)), rows)), np.array([t for _, t in train])
    w = np.array(model.coefficients)
    slope = design.T @ (y - 1 / (1 + np.exp(-design @ w))) - np.array([1e-6, *[1.0] * (len(w) - 1)]) * w
    assert np.abs(slope).max() < 1e-3, "the coefficients are where the penalised likelihood is greatest"
    got = dict(rows_of(toxicity.score_toxicity(docs, labels), "doc_id", "score"))
    for i, text in rows_of(docs, "doc_id", "text")[:60]:
        plain = 1 / (1 + math.exp(-(w[0] + np.dot(w[1:], _plain_features(text, terms, near)))))
        assert got[i] == pytest.approx(plain, abs=1e-6)
