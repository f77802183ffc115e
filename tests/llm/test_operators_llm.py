"""Operators on small fixtures: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_fixtures import awkward, llm, make_docs, no_docs, words  # noqa: F401

from streamwin.llm import (
    digests,
    mixing,
    near_duplicates,
    pieces,
    quality_cnn,
    rules,
    substrings,
    token_blocks,
    token_counts,
    toxicity,
)
from streamwin.llm.components import components

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def blocks(docs, tmp_path):
    token_blocks.write_blocks(docs, f"{tmp_path}/blocks", public_tokenizers.path("word_bpe_49k.json"))
    return token_blocks.read_documents(docs.sparkSession, f"{tmp_path}/blocks")


NETWORK = quality_cnn.train([b"good words here", b"*** $$$ %%%"] * 8, [1, 0] * 8)
TOXIC = toxicity.train(["fine day. good", "you fool. good", "a fool here", "nice day"] * 8, [0, 1, 1, 0] * 8)
EVERY = {
    "blocks": blocks,
    "cnn": lambda docs, _: quality_cnn.score(docs, NETWORK),
    "kept": lambda docs, _: quality_cnn.keep_good(docs, NETWORK, threshold=0.0),
    "digests": lambda docs, _: digests.against_next(docs),
    "fingerprints": lambda docs, _: digests.fingerprints(docs),
    "substrings": lambda docs, _: substrings.remove_repeats(docs, keep=("lang",)),
    "mixing": lambda docs, _: mixing.mix(docs),
    "near": lambda docs, _: near_duplicates.near_duplicates(docs),
    "pieces": lambda docs, _: pieces.decode(pieces.encode(docs, MODEL), MODEL),
    "toxicity": lambda docs, _: toxicity.score(docs, TOXIC),
    "rules": lambda docs, _: rules.apply_rules(docs, rules.DecisionList(())),
    "counts": lambda docs, _: token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")),
}


@pytest.mark.parametrize("name", EVERY)
def test_one_row_for_each_row(awkward, name, tmp_path):
    found = EVERY[name](awkward, tmp_path).select("doc_id").collect()
    assert Counter(row["doc_id"] for row in found) == Counter([1, 2, 3, 4, 4, 5, 6, None, 7, 7])


@pytest.mark.parametrize("name", EVERY)
def test_no_documents(no_docs, name, tmp_path):
    assert EVERY[name](no_docs, tmp_path).count() == 0


@pytest.mark.parametrize("name", EVERY)
def test_clashing_columns(make_docs, name, tmp_path):
    docs = make_docs("some words here", None)
    for clash in ("score", "block", "bucket", "size", "value", "ids", "row", "key", "mix_size", "n_words", "_w"):
        docs = docs.selectExpr("*", f"1 as {clash}")
    assert EVERY[name](docs, tmp_path).count() == 2


def test_segments_round_trip():
    rng = np.random.default_rng(0)
    for count in (0, 1, 127, 128, 129, 5000):
        for ids in (
            rng.integers(0, 50_000, count),
            np.where(rng.random(count) < 0.05, 2**32 - 1, 7),
            np.full(count, 3),
            rng.integers(0, 2**32, count),
        ):
            segment = token_blocks.Segment(token_blocks.pack(ids))
            assert (segment.ids() == ids).all()
            assert (segment.ids(120, 300) == ids[120:300]).all()


def test_ids_are_read_back(llm, make_docs, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Ab. cd!!", None, "ΣΑΣ é DON'T <|endoftext|>x", "ab"]
    token_blocks.write_blocks(make_docs(*texts), f"{tmp_path}/b", path, end_id=9)
    found = {row["doc_id"]: row["ids"] for row in token_blocks.read_ids(llm, f"{tmp_path}/b").collect()}
    library = Tokenizer.from_file(path)
    assert found == {k: library.encode(t or "", add_special_tokens=False).ids + [9] for k, t in enumerate(texts)}


def test_token_counts_of_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), token_counts.Counter(path)
    rng = random.Random(1)
    letters = "aab 's\t\n \u0085\x1cé日😀1٣.<|endoftext|>"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(500)]
    odd += ["a" * 1000, "<|endoftext|>", " <|endoftext|> a", "\n\n x  y"]
    assert counter.count(odd) == [len(library.encode(text, add_special_tokens=False).ids) for text in odd]


def test_pieces_of_odd_texts(make_docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["", " ", "  a  b\n\nc", "日本語😀 é☃", "x" * 200 + " aaaa", "<s> <unk> <0x41>", "\x00 ﬁ①"]
    # One blank in front, after the one the library adds, makes a piece of two.
    texts += [" 日本", " 1", " \tx", " the end", " a b ", " ▁x", "▁"]
    found = pieces.decode(pieces.encode(make_docs(*texts), MODEL), MODEL).collect()
    for row in found:
        assert row["ids"] == library.encode(texts[row["doc_id"]])
        assert row["decoded"] == texts[row["doc_id"]].replace("▁", " ")


def brute_repeats(rows):
    """Kept words of ``(id, text)``."""
    cut = [(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc_id, text in rows]
    least = {}
    for doc_id, found in cut:
        for k in range(len(found) - 12) if doc_id is not None else ():
            window = tuple(found[k : k + 13])
            least[window] = min(least.get(window, doc_id), doc_id)
    kept = []
    for doc_id, found in cut:
        gone = set()
        for k in range(len(found) - 12) if doc_id is not None else ():
            if least[tuple(found[k : k + 13])] < doc_id:
                gone |= set(range(k, k + 13))
        kept.append((doc_id, " ".join(w for k, w in enumerate(found) if k not in gone), len(gone)))
    return Counter(kept)


def test_repeats_against_brute_force(make_docs):
    rng = random.Random(3)
    passages = [words(rng.randrange(10, 40), 1000 * k) for k in range(5)] + ["a " * 30]
    rows = [(None, passages[0], "s"), (-5, passages[1], "s"), (-5, passages[1] + " more", "s"), (3, None, "s")]
    for doc_id in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.6 else words(rng.randrange(20), rng.randrange(9999)) for _ in range(4)]
        rows.append((doc_id, " \n".join(parts), "s"))
    found = substrings.remove_repeats(make_docs(*rows), blocks=3).collect()
    assert Counter((row["doc_id"], row["text"], row["n_removed"]) for row in found) == brute_repeats(
        [(doc_id, text) for doc_id, text, _ in rows]
    )


def brute_components(rows):
    sets = {}
    for doc_id, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", text.translate({k: k + 32 for k in range(65, 91)}))
        sets[doc_id] = {tuple(found[k : k + 5]) for k in range(len(found) - 4)} or ({tuple(found)} if found else set())
    root = {doc_id: doc_id for doc_id in sets}

    def find(doc_id):
        while root[doc_id] != doc_id:
            doc_id = root[doc_id]
        return doc_id

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc_id: (len(sets[doc_id]), find(doc_id)) for doc_id in sets}


@pytest.mark.parametrize("exact", [False, True])
def test_near_duplicates_against_brute_force(make_docs, exact):
    rng = random.Random(5)
    base = [words(size, 500 * k).split() for k, size in enumerate((3, 5, 8, 40, 120, 400))]
    rows = [(0, "", "s"), (1, "One two", "s"), (2, "one TWO", "s"), (3, "É one", "s"), (4, "é one", "s")]
    for doc_id in range(5, 150):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(1 + len(text) // 12)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(40)}"
        rows.append((doc_id, " ".join(text), "s"))
    found = near_duplicates.near_duplicates(make_docs(*rows), exact=exact).collect()
    wanted = brute_components([(doc_id, text) for doc_id, text, _ in rows])
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in found} == wanted
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in found)


def test_small_sets_are_their_own_signatures():
    few = near_duplicates.shingles(words(20, 3).encode())
    assert len(few) == near_duplicates.WHOLE and (near_duplicates.signature(few) == few).all()
    many = near_duplicates.shingles(words(400, 3).encode())
    assert len(near_duplicates.signature(many)) <= 64


def test_components_of_a_path_and_a_star(llm):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 120)] + [(7, 7)]
    found = components(llm.createDataFrame(links, "a long, b long")).collect()
    assert {row["node"]: row["root"] for row in found} == {
        **{k: 0 for k in range(1, 31)},
        **{k: 100 for k in range(101, 120)},
    }


def test_mix_of_empty_and_full_sources(make_docs):
    docs = make_docs((1, words(10), "a"), (2, words(1000), "b"), (3, None, "c"), (4, words(5), None), (5, words(7), "b"))
    found = {row["doc_id"]: row for row in mixing.mix(docs).collect()}
    assert [found[k]["mix_target"] for k in (1, 3, 4)] == [20.0, 0.0, 10.0]
    assert found[1]["mix_taken"] == 20 and found[4]["mix_taken"] == 10
    total = 1.5 * 1022 - 30
    assert found[2]["mix_target"] == pytest.approx(total)
    assert found[2]["mix_taken"] + found[5]["mix_taken"] == int(total)
    taken = Counter()
    for row in mixing.repeated(mixing.mix(docs)).collect():
        taken[row["doc_id"]] += len(row["text"].split())
    assert taken == Counter({k: row["mix_taken"] for k, row in found.items() if row["mix_taken"]})


def test_digests_of_equal_and_short_texts():
    same = digests.digest(b"a text about something")
    assert digests.likeness(same, digests.digest(b"a text about something")) == 1.0
    assert digests.likeness(digests.digest(b""), digests.digest(b"")) == 1.0
    assert 0.0 <= digests.likeness(digests.digest(b""), same) < 0.5


def test_chunks_cover_long_texts():
    tail = b"x" * 5000 + b"***"
    chunks, owner = quality_cnn.chunked([b"", tail])
    assert (owner == 0).sum() == 1
    assert any(bytes(row[row < 256].astype(np.uint8)).endswith(b"***") for row in chunks[owner == 1])


def test_digest_and_difference_against_plain_loops():
    import math

    def counts(data):
        found = Counter()
        for a, b, c in zip(data, data[1:], data[2:]):
            mixed = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32
            mixed = (mixed ^ mixed >> 15) * 0x85EBCA6B % 2**32
            found[mixed >> 24] += 1
        return [found[bucket] for bucket in range(256)]

    def codes(data):
        found = counts(data)
        limits = [sorted(found)[256 * quarter // 4] for quarter in (1, 2, 3)]
        return [sum(count > limit for limit in limits) for count in found]

    def plain(data):
        quartiles = codes(data)
        packed = [sum(quartiles[at + k] << 2 * k for k in range(4)) for at in range(0, 256, 4)]
        return f"{round(math.log2(len(data) + 1) * 16):03x}" + bytes(packed).hex()

    def alike(one, other):
        a, b = codes(one), codes(other)
        steps = abs(round(math.log2(len(one) + 1) * 16) - round(math.log2(len(other) + 1) * 16))
        most = sum(a) + sum(b)
        if not most:
            return float(steps == 0)
        return 1 - min(most, sum(abs(x - y) for x, y in zip(a, b)) + 12 * steps) / most

    rng = random.Random(8)
    made = [bytes(rng.choices(b"abcdefgh \xc3\xa9.", k=size)) for size in (0, 1, 2, 3, 40, 700, 5000)]
    made += [made[-1][:4000] + made[-2], made[-1]]
    for one in made:
        assert digests.digest(one) == plain(one)
        for other in made:
            assert digests.likeness(digests.digest(one), digests.digest(other)) == pytest.approx(alike(one, other))


def test_verdict_in_frames_equals_the_list_of_conditions(make_docs):
    rng = random.Random(9)
    letters = ["word", "WORD", "#", "!", "a", "one two", "x\nx\n", "yes!!", "$%&"]
    texts = [" ".join(rng.choices(letters, k=rng.randrange(1, 120))) for _ in range(200)] + [None, "", " \n"]
    docs = make_docs(*texts)
    names = list(rules.FEATURES)
    values = rules.statistics(docs).select("doc_id", *(make().cast("double").alias(n) for n, make in rules.FEATURES.items()))
    features = {row["doc_id"]: {name: row[name] for name in names} for row in values.collect()}
    middle = {name: sorted(row[name] for row in features.values())[len(features) // 2] for name in names}
    made = [[rules.Condition(n, rng.random() < 0.5, middle[n]) for n in rng.sample(names, 2)] for _ in range(3)]
    ordered = rules.DecisionList(tuple(map(tuple, made)))
    seen = set()
    for row in rules.apply_rules(docs, ordered).collect():
        assert row["kept"] == (not row["base_failed"] and ordered.keeps(features[row["doc_id"]]))
        seen.add((row["base_failed"], row["kept"]))
    assert seen == {(True, False), (False, False), (False, True)}


def test_worst_sentence_of_toxic_texts(make_docs):
    texts = ["nice day. you fool! good", "fine day. good", None, "", "a fool\x01here. day", "FOOL. fool"]
    found = {row["doc_id"]: row for row in toxicity.score(make_docs(*texts), TOXIC, threshold=0.3).collect()}
    spans = {doc_id: (row["worst_start"], row["worst_stop"]) for doc_id, row in found.items()}
    assert spans == {0: (9, 18), 1: (None, None), 2: (None, None), 3: (None, None), 4: (0, 11), 5: (0, 4)}
    assert [str(found[doc_id]["score"]) for doc_id in (2, 3)] == ["0.0", "0.0"]
    assert found[4]["score"] == TOXIC.score("a fool here. day")


def test_vocabulary_that_reaches_across_blanks_is_refused():
    with pytest.raises(ValueError, match="across blanks"):
        token_blocks.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_word_encoder_of_odd_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    letters = [*"aB  .,!?#*\t\n\x0b\x0c\r\x1c\x85\u2028日é́ß😀'-09", "the", "And", "  ", "\x00", "İ"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(0, 25))) for _ in range(3000)]
    library, encoder = Tokenizer.from_file(path), token_blocks.WordEncoder(path)
    for start in range(0, len(texts), 1000):
        part = texts[start : start + 1000]
        for text, ids in zip(part, encoder.encode(pa.array(part)), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert [ids.tolist() for ids in encoder.encode(pa.array(["x", None, "", " a"]).slice(1))][:2] == [[], []]


def test_offending_sentences(make_docs):
    found = toxicity.offending_sentences(make_docs("nice day. you fool! good", None), TOXIC, threshold=0.3).collect()
    assert [(row["doc_id"], row["sentence"], row["start"], row["stop"]) for row in found] == [(0, " you fool", 9, 18)]


def test_learned_list_finds_a_conjunction(make_docs):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        row = {name: rng.random() for name in rules.FEATURES}
        rows.append((row, row["symbols_per_char"] > 0.6 and row["words"] <= 0.4))
    learned = rules.Learner().fit(rows)
    assert sum(learned.keeps(row) != bad for row, bad in rows) >= 0.95 * len(rows)
    assert rules.Learner().fit([]).rules == ()


def test_classifiers_without_labels(llm, make_docs):
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs("a b", None)
    assert quality_cnn.score(docs, quality_cnn.learn(docs, labels)).count() == 2
    assert toxicity.score(docs, toxicity.learn(docs, labels)).where("predicted = 1").count() == 0
    assert rules.learn_rules(docs, labels).rules == ()


def test_mix_does_not_depend_on_partitions(llm, make_docs):
    rows = [(at % 3 or None, f"text {at} " * (at % 4 + 1), "s" if at % 2 else "t") for at in range(51)]
    docs = make_docs(*rows)
    seen = []
    for count in (1, 3, 7):
        mixed = mixing.mix(docs.repartition(count), share=0.7)
        seen.append(sorted((tuple(row) for row in mixed.select("doc_id", "text", "mix_taken").collect()), key=str))
    assert seen[0] == seen[1] == seen[2]


def test_repeated_replaces_its_own_column(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs("a b c", "d e").withColumn("mix_pass", F.lit("mine"))
    found = mixing.repeated(mixing.mix(docs)).select("text", "mix_pass").collect()
    assert {type(row["mix_pass"]) for row in found} == {int}


def test_networks_keep_their_own_tables():
    import pickle

    from streamwin.llm.quality_cnn import Network

    texts = [b"some text", b"", b"0123456789" * 200]
    for seed in range(50):
        network = Network.fresh(seed)
        sent = pickle.loads(pickle.dumps(network))
        assert "trained" not in sent.__dict__
        fresh = sent.score(texts)
        assert (network.score(texts) == fresh).all()
        assert "trained" not in pickle.loads(pickle.dumps(network)).__dict__


def test_convolution_against_plain_loops():
    import math

    from streamwin.llm.quality_cnn import CHUNK, FILTERS, STRIDE, WIDTH, Network

    network = Network.fresh(4)
    network.bias[:] = 0.1
    for text in (b"", b"ab", b"The quick brown fox. " * 60):
        rows = []
        for start in range(0, max(1, len(text) - (CHUNK - STRIDE)), STRIDE):
            best = []
            for f in range(FILTERS):
                places = range(start, min(start + CHUNK, len(text)))
                responses = [
                    sum(float(network.filters[j, text[at + j], f]) for j in range(WIDTH) if at + j < len(text))
                    for at in places
                ]
                best.append(max(0.0, max(responses, default=-1e9) + float(network.bias[f])))
            rows.append(best)
        top = [max(column) for column in zip(*rows, strict=True)]
        mean = [sum(column) / len(rows) for column in zip(*rows, strict=True)]
        total = sum(w * v for w, v in zip(network.weights.tolist(), top + mean, strict=True)) + network.offset
        assert network.score([text])[0] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)


def test_noisy_or_against_plain_loops():
    import math

    labelled = [("you stink badly. have a nice day", 1), ("a fine morning. we walk", 0), ("nice day. fine walk", 0)] * 20
    model = toxicity.train([text for text, _ in labelled], [label for _, label in labelled])
    for text, _ in labelled[:3]:
        clean = 1.0
        for sentence in filter(str.strip, text.split(".")):
            clean *= 1 - 1 / (1 + math.exp(-float(model.sentence_logits(sentence)[0])))
        assert model.score(text) == pytest.approx(1 - clean, abs=1e-9)
    assert model.score(labelled[0][0]) > model.score(labelled[1][0])


def test_pieces_shuffle_numbers_and_no_texts(make_docs):
    """What is dealt out is a fraction of the texts, from which the units come back in order."""
    given = [" ".join(f"word{k % 97} thing{k % 89}" for k in range(at, at + 400)) for at in range(50)]
    given += [None, "", " ", " two  blanks ", "日本 ▁é", "\n\t"]
    packed = pieces._numbered(MODEL, pa.chunked_array([given]), 4)
    assert sum(map(len, packed)) < sum(len(text or "") for text in given) / 4
    posted, starts, numbers = map(pieces._unpacked, packed)
    begins = np.frombuffer(starts, np.int64)
    assert len(begins) == 5 and begins[0] == 0 and begins[-1] == len(posted)
    units = posted.decode().split(" ")[:-1]
    reply = b"".join((at + pieces._LAST).to_bytes(3, "big") for at in range(len(units)))
    ids, sizes = pieces._ids_of(numbers, reply)
    ends = np.cumsum(sizes).tolist()
    for text, start, end in zip(given, [0, *ends], ends, strict=False):
        shown = ("▁" + text.replace(" ", "▁")) if text else ""
        assert "".join(units[at] for at in ids[start:end]) == shown

    plan = str(pieces.encode(make_docs(*given), MODEL)._jdf.queryExecution().executedPlan()).splitlines()
    dealt = [below for line, below in zip(plan, plan[1:], strict=False) if "Exchange" in line]
    assert dealt and not any("text" in line and "MapInArrow" not in line for line in dealt)
