r"""Languages of documents and of their stretches by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is bound by multiplying its letters' vectors, each
rotated by its place; a text is the bundle (sum) of its trigram vectors; a language prototype is the bundle of
its sample texts, less the mean of all prototypes. A text belongs to the prototype with the highest cosine.

The dot product of a trigram vector with a prototype does not depend on the text, so the products of all trigrams
of the (fixed) alphabet are computed once: a table of alphabet^3 x languages, the same size for any corpus, which
every worker holds. A sentence is then a sum over its trigrams' rows.

Stretches: the sentences' scores are decoded with a cost per change of language (Viterbi). Markup and quoted
titles take no part; headings and other scraps without letters follow their neighbours.

A sentence weighs by its length, since the products of its trigrams are summed; different trigrams have independent
vectors, so the norm of a bundle is that of its counts but for noise of one over the root of the dimensions.

Null texts and texts without letters give no row; a text in letters outside the table is ``und`` with confidence 0.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import plain as whole_frame
from shelfspark.session import spread

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåçèéêëìíîïñòóôõöùúûüßœ"
_CODE = np.zeros(0x110000 // 256, dtype=np.uint8)  # letters of the table lie below this
for _i, _c in enumerate(LETTERS, start=1):
    _CODE[ord(_c)] = _i
SIZE = len(LETTERS) + 1
#: The language of a text whose letters are all outside the table.
UNKNOWN = "und"
# Tags of any length; a comment that only closes after 200 characters is taken for text, so that a stray opening swallows nothing.
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|<[^<>]{1,200}>")
_QUOTE = re.compile(r"\"[^\"\n]{1,250}\"|«[^»\n]{1,250}»|„[^“”\n]{1,250}[“”]|“[^”\n]{1,250}”")
_HYPHEN = re.compile(r"(?<=\w)[-‐]\r?\n[>\s]*(?=\w)")
_CITED = re.compile(r"^[>\s]+", re.MULTILINE)
_END = re.compile(r"(?<=[.!?…])[\"»”“)]*\s+|\n+")


def codes(text: str) -> np.ndarray:
    """Letter numbers of the lower-cased text, everything else 0, runs of it as one, ends included."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    c = _CODE[np.where(raw < len(_CODE), raw, 0)]
    return c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]


def trigrams(text: str) -> np.ndarray:
    c = codes(text).astype(np.int32)
    return (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:] if len(c) > 2 else np.zeros(0, np.int32)


def plain(text: str) -> str:
    """Without markup and quoted titles, words and sentences that line breaks cut put together again.

    A line break ends a sentence after a closing mark or a short line (a heading); an empty line always does.
    """
    s = _HYPHEN.sub("", _TAG.sub("\n\n", html.unescape(text)).replace("\u00ad", ""))
    out = []
    for block in re.split(r"\n\s*\n", _CITED.sub("", s.replace("\r", "")) if ">" in s else s.replace("\r", "")):
        lines = block.split("\n")
        for line in lines[:-1]:
            t = line.rstrip()
            out.append(t + ("\n" if not t or t[-1] in ".!?…:" or len(t.split()) <= 6 else " "))
        out.append(lines[-1] + "\n")
    return _QUOTE.sub(" ", "".join(out))


def unaccented(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def sentences(text: str) -> list[tuple[str, bool]]:
    """(sentence, whether it is a heading): a heading is a short line that no mark ends."""
    out = []
    for part in _END.split(plain(text)):
        s = part.strip()
        if s:
            out.append((s, len(s.split()) <= 6 and s[-1] not in ".!?…:;,"))
    return out


def letter_vectors(dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0], dtype=np.float32), (SIZE, dims))


def score_table(
    samples: dict[str, list[str]], dims: int = 2048, seed: int = 7, per_language: int = 1500, epochs: int = 20
) -> tuple[list[str], np.ndarray]:
    """(languages, table): cosine contributions of every trigram with every prototype.

    After bundling, the prototypes are retrained: sample sentences that do not clear a margin are added to their own
    prototype and taken from the rival. Labels may be wrong, so sentences far from their label take no part.
    """
    langs = sorted(samples)
    letters = letter_vectors(dims, seed)
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    protos = np.zeros((dims, len(langs)), dtype=np.float32)
    vectors, labels = [], []
    pair = (first[:, None, :] * second[None, :, :]).reshape(SIZE * SIZE, dims)
    for k, x in enumerate(langs):
        n = np.zeros(SIZE**3, dtype=np.float32)
        sents = list(dict.fromkeys(v for t in samples[x] for s, h in sentences(t) if not h for v in (s, unaccented(s))))
        for s in sents:
            np.add.at(n, trigrams(s), 1)
        # the root: a phrase that a corpus repeats must not fill the prototype
        protos[:, k] = ((np.sqrt(n).reshape(SIZE * SIZE, SIZE) @ letters) * pair).sum(axis=0)
        for s in sents[:: max(1, len(sents) // per_language)]:
            g = trigrams(s)
            if len(g) >= 8:
                v = (pair[g // SIZE] * letters[g % SIZE]).sum(axis=0)
                vectors.append(v / (np.linalg.norm(v) + 1e-9))
                labels.append(k)
    protos /= np.linalg.norm(protos, axis=0) + 1e-9
    if len(langs) > 1:
        protos -= protos.mean(axis=1, keepdims=True)
    protos /= np.linalg.norm(protos, axis=0) + 1e-9
    if vectors:
        h, y = np.array(vectors, dtype=np.float32), np.array(labels)
        at = np.arange(len(y))
        scores = h @ protos
        own = scores[at, y]
        near = scores.max(axis=1) - own <= 0.06
        h, y = h[near], y[near]
        at = np.arange(len(y))
        for _ in range(epochs if len(y) else 0):
            scores = h @ protos
            own = scores[at, y].copy()
            scores[at, y] = -9 if len(langs) > 1 else own
            rival = scores.argmax(axis=1)
            weak = own - scores[at, rival] < 0.12
            for k in range(len(langs)):
                up, down = h[weak & (y == k)], h[weak & (rival == k)]
                protos[:, k] += 0.5 * (up.sum(axis=0) - down.sum(axis=0)) / max(1, len(y) // len(langs)) * 4
            protos /= np.linalg.norm(protos, axis=0) + 1e-9
    table = np.zeros((SIZE**3, len(langs)), dtype=np.float32)
    for c in range(SIZE):
        table[c::SIZE] = ((pair * letters[c]) @ protos) / np.sqrt(dims)
    return langs, table


def decode(scores: np.ndarray, change: float) -> np.ndarray:
    """The best path of languages over sentences when every change costs ``change``."""
    n, m = scores.shape
    best = np.zeros((n, m))
    back = np.zeros((n, m), dtype=int)
    best[0] = scores[0]
    for i in range(1, n):
        stay = best[i - 1]
        top = int(stay.argmax())
        move = stay[top] - change
        back[i] = np.where(stay >= move, np.arange(m), top)
        best[i] = np.maximum(stay, move) + scores[i]
    path = np.zeros(n, dtype=int)
    path[-1] = int(best[-1].argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    return path


def stretches(text: str, langs: list[str], table: np.ndarray, change: float) -> list[tuple[str, float, str]]:
    """(language, confidence, text) of every maximal stretch."""
    sents = sentences(text)
    if not sents:
        return []
    grams = [trigrams(s) for s, _ in sents]
    raw = np.array([table[g].sum(axis=0) if len(g) else np.zeros(len(langs)) for g in grams])
    heads = np.array([h for _, h in sents])
    weight = np.where(heads & (~heads).any(), 0.0, 1.0)
    if not any(len(g) for g in grams):
        return [(UNKNOWN, 0.0, " ".join(s for s, _ in sents))] if any(c.isalpha() for s, _ in sents for c in s) else []
    path = decode(raw * weight[:, None], change)
    if (weight == 0).any():  # a heading goes with what follows it, the last with what precedes it
        for i in range(len(path) - 1, -1, -1):
            if not weight[i]:
                path[i] = path[i + 1] if i + 1 < len(path) else path[max((j for j in range(i) if weight[j]), default=i)]
    out = []
    i = 0
    while i < len(path):
        j = i
        while j < len(path) and path[j] == path[i]:
            j += 1
        g = np.concatenate(grams[i:j]) if j > i else grams[i]
        _, n = np.unique(g, return_counts=True)
        cos = raw[i:j].sum(axis=0) / max(1e-9, float(np.sqrt((n.astype(float) ** 2).sum())))
        z = np.exp(8 * (cos - cos.max()))
        out.append((langs[path[i]], float(z[path[i]] / z.sum()), " ".join(s for s, _ in sents[i:j])))
        i = j
    return out


def sample_texts(df: DataFrame, text: str, lang: str, key: str, languages: tuple[str, ...], rows: int, chars: int) -> dict[str, list[str]]:
    """At most ``rows`` labelled rows, those least by a hash of the key, each at most ``chars`` characters long."""
    labelled = df.where(F.col(lang).isin(*languages) & F.col(text).isNotNull())
    picked = labelled.select(lang, F.substring(text, 1, chars).alias("t"), F.xxhash64(key).alias("h")).orderBy("h").limit(rows).collect()
    out: dict[str, list[str]] = {x: [] for x in languages}
    for r in picked:
        out[r[lang]].append(r["t"])
    return {k: v for k, v in out.items() if v}


def identify(
    df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    languages: tuple[str, ...] = ("de", "en", "es", "fr", "it", "pt"), rows: int = 4000, chars: int = 2000, dims: int = 2048, change: float = 0.25,
) -> DataFrame:
    """(key, label, seg_no, n_segs, lang, confidence, n_chars) of every stretch of every document.

    The prototypes are fitted on a bounded sample of labelled rows (``rows`` x ``chars``, and retrained on at most twice
    ``per_language`` of their sentences for each language); every text is read whole.
    """
    samples = sample_texts(df, text, lang, key, languages, rows, chars)
    if not samples:
        samples = {x: [""] for x in languages}
    langs, table = score_table(samples, dims)
    shared = df.sparkSession.sparkContext.broadcast(table)  # alphabet^3 x languages, whatever the corpus

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for pdf in it:
            out = []
            for k, s, label in zip(pdf["k"], pdf["t"], pdf["l"], strict=True):
                got = stretches(s, langs, t, change)
                out += [(k, label, n, len(got), x, conf, len(part)) for n, (x, conf, part) in enumerate(got, start=1)]
            frame = pd.DataFrame(out, columns=["key", "label", "seg_no", "n_segs", "lang", "confidence", "n_chars"])
            yield whole_frame(frame.astype({"seg_no": "int64", "n_segs": "int64", "n_chars": "int64", "confidence": "float64"}))

    src = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    kind = src.schema["k"].dataType.simpleString()
    return spread(src).mapInPandas(run, f"key {kind}, label string, seg_no bigint, n_segs bigint, lang string, confidence double, n_chars bigint")


def relabelled(segments: DataFrame) -> DataFrame:
    """Stretches of documents whose label is not exactly their only language."""
    return segments.where((F.col("n_segs") > 1) | ~F.coalesce(F.col("label") == F.col("lang"), F.lit(False)))
