"""Cross-tokenizer alignment against the offsets that the libraries give."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.llm.cases import DOCS, awkward, awkward_rows, empty
from voxledger.llm import token_alignment as t

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "a", "  two  spaces ", "Hello world, it's 2024!", "naïve café — “quoted”", "日本語のテキスト", "emoji 🙂🙂 end",
    "▁ is the space of pieces", "<|endoftext|> and <s> </s> <0x41>", "tab\tline\nfeed\r\nend\n\n", "a\x00b", "x" * 300,
    "ﬁ ligature ½ Å", "ɐ ʃ Δ Ж", "trailing   ", "  \u0085 \xa0 spaces", "repeat repeat repeat",
]


def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def token_bytes(a, b, text):
    """Ids and bytes of every token, from the libraries alone."""
    from tokenizers import decoders

    back = {}
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = 0
    for byte in range(256):
        if byte in visible:
            back[chr(byte)] = byte
        else:
            back[chr(256 + extra)] = byte
            extra += 1
    assert decoders.ByteLevel().decode(["Ġa"]) == " a"
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    return ids_a, bytes_a, ids_b, bytes_b


def brute(table):
    a, b = libraries()
    held, per_doc = Counter(), []
    for id_, text, *_ in table:
        links, groups = [], []
        ids_a, bytes_a, ids_b, bytes_b = token_bytes(a, b, text) if text else ([], [], [], [])
        whole = b" " + (text or "").encode()
        if text and b"".join(bytes_a) == whole and b"".join(bytes_b) == whole:
            ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
            start_a, start_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
            j0 = 0
            for i, x in enumerate(ids_a):
                while ends_b[j0] <= start_a[i]:
                    j0 += 1
                j = j0
                while j < len(ids_b) and start_b[j] < ends_a[i]:
                    links.append((x, ids_b[j]))
                    j += 1
            i = j = 0
            for cut in sorted(set(ends_a) & set(ends_b)):
                k, m = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
                groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
                i, j = k, m
        else:
            ids_a, ids_b = [], []
        held.update(set(links))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        per_doc.append((id_, len(ids_a), len(ids_b), len(groups), links, sha))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        ((i, n_a, n_b, g, len(k), sum(held[p] == most[p[0]] for p in k), sum(held[p] for p in k), sha) for i, n_a, n_b, g, k, sha in per_doc),
        key=repr,
    )


def got(df, **kwargs):
    made = t.align_documents(df, lambda: (t.byte_level_tokenizer(A), t.piece_tokenizer(B)), **kwargs)
    assert made.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in made.collect()), key=repr)


@pytest.mark.parametrize("shard_bytes", [1, 60, 1 << 22])
def test_texts(spark, shard_bytes):
    """Shards of one document, of a few, and one shard per task give one result."""
    table = [(i, text, None, None, None) for i, text in enumerate(TEXTS)]
    df = spark.createDataFrame(table, DOCS).repartition(2)
    assert got(df, shard_bytes=shard_bytes) == brute(table)


def test_awkward_rows(spark):
    want = brute(awkward_rows())
    assert got(awkward(spark)) == want
    assert got(awkward(spark, clashing=True), shard_bytes=200) == want
    assert got(empty(spark)) == []
    assert got(spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, None)], DOCS)) == brute([(1, None), (None, "")])


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs, shard_bytes=50_000) == brute(table)


def test_a_row_is_a_document_or_a_pair_and_never_a_shard(spark):
    """600 documents fill one shard of a task: no row or batch that leaves it grows with the shard."""
    rng = np.random.default_rng(6)
    words = [f"w{i}x" for i in range(3000)]
    table = [(i, " ".join(rng.choice(words, 60)), None, None, None) for i in range(600)]
    docs = spark.createDataFrame(table, DOCS).repartition(1)
    shards = t.pack(docs.select("doc_id", "text").withColumnRenamed("doc_id", "id"), lambda: (t.byte_level_tokenizer(A), t.piece_tokenizer(B)))
    rows = [r.asDict(recursive=True) for r in shards.collect()]
    assert len({r["shard"] for r in rows}) == 1 and sum(r["n_links"] or 0 for r in rows) > 100_000
    assert max(len(repr(r)) for r in rows) < 20_000
    assert got(docs) == brute(table)


def test_fast_encoder_gives_the_library_ids():
    """Every character below U+0240 in several places, and mixtures of them."""
    library, _ = libraries()
    fast = t.byte_level_tokenizer(A)
    points = [c for c in map(chr, range(0x240))]
    rng = np.random.default_rng(4)
    texts = [f"a{c}b {c} {c}{c}1{c}\n{c} 's{c}" for c in points]
    texts += ["".join(rng.choice(points, 40)) for _ in range(3000)]
    texts += [f"{c}'ll {c}<|endoftext|>{c}  {c}" for c in points]
    assert not any(text.encode().translate(None, t.LATIN) for text in texts)
    for text, ids in zip(texts, fast.encode(texts)):
        assert ids.tolist() == library.encode(" " + text, add_special_tokens=False).ids, text


def test_links_and_groups_of_random_cuts():
    """Intervals from random cuts: links by definition, groups between common ends."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        cut = lambda: np.array(sorted({n, *rng.integers(1, n + 1, rng.integers(0, n)).tolist()}))
        a, b = cut(), cut()
        found = t.align(a, b)
        starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
        pairs = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
        assert list(zip(found.link_a.tolist(), found.link_b.tolist())) == pairs
        common = sorted(set(a) & set(b))
        assert found.n_groups == len(common) and len(pairs) == len(a) + len(b) - len(common)
        assert found.group_a.tolist() == np.searchsorted(common, a).tolist()
        assert found.group_b.tolist() == np.searchsorted(common, b).tolist()
