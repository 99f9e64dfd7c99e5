"""Cross-tokenizer alignment against whole tokenisation and a plain byte-by-byte version."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from cohortline.llm import crosstoken
from cohortline.llm.crosstoken import Alignment, Tokens, align_text, op13_crosstoken_align, tokenizer_paths
from tests.conftest import SF_SMALL

ODD = [None, "", " ", "\n", "a", " a", "a ", "a  b", "a\n", "\na", "a\nb", "a\n b", "a \nb", "a\n\nb", "a\n\n\n b", "x.\nY, z", "a\tb", "a\r\nb;\r c",
       "it's Don't 'quoted' 're", "x-1'2é 3.5%", "a▁b", "▁", "<s> </s> <unk> <0x41>", "<|endoftext|> x<|endoftext|>", "\x00\x01 z", "ﬁ ① é 漢字かな 🙂🙂",
       "a b　c d", "éèàç Ünïts straße", "word,,, word... ?!", "if(a){return b;}\n  x", "0x41 <0x0A>\n<0x0A>", "The the THE tHe", "a" * 3000, "ab " * 3000,
       "日本語" * 400, " .", ". ,", "a.b,c d.", "$$$ ### a### $5", "\u0085x", "end​ ​start", "½² ²."]


class Plain:
    """Both tokenisers on whole texts, and the alignment by walking the bytes."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        a, b = tokenizer_paths()
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        keep = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
        self.letters = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}

    def tokens(self, text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        e = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.letters[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        same = b"".join(t for _, t in a) == raw == b"".join(t for _, t in b)
        return (a, b) if same else ([], [])

    def align(self, text):
        """(n_a, n_b, groups as text, linked id pairs)."""
        a, b = self.tokens(text)
        owner = [[], []]
        for side, tokens in enumerate((a, b)):
            for k, (_, t) in enumerate(tokens):
                owner[side] += [k] * len(t)
        links = sorted(set(zip(*owner)))
        groups, ids = [], ([], [])
        for k in range(len(owner[0])):
            for side, tokens in enumerate((a, b)):
                if k == 0 or owner[side][k] != owner[side][k - 1]:
                    ids[side].append(tokens[owner[side][k]][0])
            if k + 1 == len(owner[0]) or all(o[k] != o[k + 1] for o in owner):
                groups.append("|".join(",".join(map(str, x)) for x in ids))
                ids = ([], [])
        return len(a), len(b), groups, [(a[i][0], b[j][0]) for i, j in links]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def whole(plain, docs):
    out, count = [], Counter()
    aligned = [(i, *plain.align(t)) for i, t in docs]
    for *_, links in aligned:
        count.update(set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    for i, n_a, n_b, groups, links in aligned:
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return Counter(out)


def test_tokens_are_those_of_whole_texts(plain):
    tokens = Tokens(*tokenizer_paths())
    assert tokens.words and tokens.marks
    r = random.Random(3)
    bits = ["the", "Éa", "x.", "it's", "\n", " ", "  ", "\n\n", "漢", "9", "don", "!", "a1", "▁", "\t", "🙂", "ing,", "Z?!", "'", "-"]
    texts = [t or "" for t in ODD] + ["".join(r.choices(bits, k=r.randrange(1, 25))) for _ in range(1500)]
    texts += [" ".join(r.choices(bits, k=12)) for _ in range(500)]
    n_a, a, n_b, b = tokens(texts)
    i = j = 0
    for text, n, m in zip(texts, n_a.tolist(), n_b.tolist()):
        want = plain.tokens(text)
        assert a[i:i + n].tolist() == [k for k, _ in want[0]], repr(text)
        assert b[j:j + m].tolist() == [k for k, _ in want[1]], repr(text)
        i, j = i + n, j + m


def test_groups_of_a_text(plain):
    for text in ODD:
        groups = align_text(text or "")
        assert ["|".join(",".join(map(str, x)) for x in g) for g in groups] == plain.align(text)[2]


def test_query_against_brute_force(spark, plain):
    got = op13_crosstoken_align(spark, SF_SMALL)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == whole(plain, docs)


@pytest.mark.parametrize("links, known, chars", [(1 << 20, 700_000, 2_000_000), (30, 5, 40)])
def test_odd_rows_small_chunks_and_a_short_memory(spark, plain, monkeypatch, links, known, chars):
    monkeypatch.setattr(crosstoken, "CHUNK_LINKS", links)
    monkeypatch.setattr(crosstoken, "KNOWN_WORDS", known)
    monkeypatch.setattr(crosstoken, "KNOWN_WINDOWS", known)
    monkeypatch.setattr(crosstoken, "HELD_CHARS", chars)
    docs = [(k if k % 5 else None, t) for k, t in enumerate(ODD)] + [(7, "same row")] * 3 + [(8, "a copy of some words")] * 40
    df = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "doc_id long, text string, chunk int, pairs string, n string").repartition(3)
    got = Alignment(df).digests()
    assert Counter(tuple(r) for r in got.collect()) == whole(plain, docs)


def test_pairs_and_their_counts(spark, plain):
    docs = [(1, "the house, the Häuser"), (2, "the the"), (3, None), (4, "Häuser")]
    rows = Alignment(spark.createDataFrame(docs, "doc_id long, text string")).pairs().collect()
    count = Counter(p for _, t in docs for p in set(plain.align(t)[3]))
    assert {(r.pair >> 16, r.pair & 0xFFFF): r.n for r in rows} == count
    assert all(r.best == (r.n == max(n for (a, _), n in count.items() if a == r.pair >> 16)) for r in rows)


@pytest.mark.parametrize("texts", [[], [None, ""]])
def test_nothing_to_align(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(tuple(r) for r in Alignment(df).digests().collect()) == [(k, 0, 0, 0, 0, 0, 0, "") for k in range(len(texts))]
