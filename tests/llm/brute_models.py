"""Plain versions of the two text models: features from the bytes of each text, one
document a step, ordinary lists instead of slices and shared buffers. They share with the
operators the fixed hash numbers and the constants of training."""

import math

import numpy as np

from lakeq.llm import langid, quality, textvec

M = 2**64 - 1
BYTE = [int(x) for x in textvec._BYTE]
MIX = [int(x) for x in textvec.MIX]
STEP = int(textvec._STEP)
SPACES = b" \t\n\v\f\r"


def mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & M
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & M
    return h ^ (h >> 31)


def ngram_buckets(data, n, bits):
    found = []
    for at in range(len(data) - n + 1):
        code = n << 56
        for j in range(n):
            code += data[at + j] << 8 * j
        found.append((code * MIX[61] & M) >> (64 - bits))
    return found


def word_hash(word):
    total, power = 0, 1
    for b in word:
        total = (total + BYTE[b] * power) & M
        power = power * STEP & M
    return mix((total + len(word) * MIX[63]) & M)


def quality_features(text):
    data = bytes(32 if b in SPACES else b for b in (text or "").encode())
    found = [x for n in quality.SIZES for x in ngram_buckets(data, n, quality.BITS)]
    words = [word_hash(w) for w in data.split(b" ") if w]
    pairs = [MIX[59] if a == b else mix((b * MIX[0] + a * MIX[1]) & M) for a, b in zip(words, words[1:])]
    return found + [h >> (64 - quality.BITS) for h in words + pairs]


def shares(found):
    out = {}
    for x in found:
        out[x] = out.get(x, 0) + 1 / len(found)
    return out


def logistic(z):
    return 1 / (1 + math.exp(-max(-50, min(50, z))))


def quality_scores(train, ask, min_steps):
    """Scores of ``ask`` after training on ``train`` [(text, 0 or 1)], in double precision."""
    docs = [(shares(quality_features(t)), y) for t, y in train]
    rng = np.random.Generator(np.random.PCG64(1))
    start = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (1 << quality.BITS, quality.DIM))
    vectors = {x: start[x].astype(np.float32).astype(float) for d in [*(d for d, _ in docs), *map(shares, map(
        quality_features, ask))] for x in d}
    out, bias = np.zeros((2, quality.DIM)), [0.0, 0.0]
    epochs = max(quality.EPOCHS, -(-min_steps // len(docs)))
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            doc, y = docs[i]
            rate = quality.RATE * (1 - step / (epochs * len(docs)))
            step += 1
            hidden = sum((share * vectors[x] for x, share in doc.items()), np.zeros(quality.DIM))
            z = [float(out[c] @ hidden) + bias[c] for c in (0, 1)]
            e = [math.exp(v - max(z)) for v in z]
            error = [e[c] / sum(e) - (c == y) for c in (0, 1)]
            down = error[0] * out[0] + error[1] * out[1]
            for c in (0, 1):
                out[c] = out[c] - rate * error[c] * hidden
                bias[c] -= 0.1 * rate * error[c]
            for x, share in doc.items():
                vectors[x] = vectors[x] - rate * len(doc) ** 0.5 * share * down
    scores = []
    for text in ask:
        hidden = sum((share * vectors[x] for x, share in shares(quality_features(text)).items()), np.zeros(quality.DIM))
        scores.append(logistic(float((out[1] - out[0]) @ hidden) + bias[1] - bias[0]))
    return scores


def language_features(text):
    letters = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").lower().encode())
    data = b" ".join(w for w in letters.split(b" ") if w)
    # a gap at either end of the text stays one space, and every text begins with the byte it has
    data = (b" " if letters[:1] == b" " else b"") + data + (b" " if letters[-1:] == b" " and data else b"")
    return [x for n in langid.SIZES for x in ngram_buckets(data, n, langid.BITS)]


def languages(train, ask):
    """(language, probability, gap) of ``ask`` after training on [(text, lang)]."""
    names = sorted({lang for _, lang in train})
    codes = langid.codewords(len(names))
    width = codes.shape[1]
    docs = [(shares(language_features(t)), codes[names.index(lang)]) for t, lang in train]
    weight, bias = {}, np.zeros(width)
    rng = np.random.Generator(np.random.PCG64(2))
    step, steps = 0, langid.EPOCHS * len(docs)

    def margin(doc):
        return sum((share * weight.get(x, np.zeros(width)) for x, share in doc.items()), np.zeros(width)) + bias
    for _ in range(langid.EPOCHS):
        for i in rng.permutation(len(docs)):
            doc, code = docs[i]
            rate = langid.RATE * (1 - step / steps)
            step += 1
            m = margin(doc)
            pull = np.array([code[b] * logistic(-code[b] * m[b]) for b in range(width)])
            for x, share in doc.items():
                weight[x] = weight.get(x, np.zeros(width)) + rate * share * pull
            bias = bias + 0.01 * rate * pull
    out = []
    for text in ask:
        m = margin(shares(language_features(text)))
        loss = [sum(math.log1p(math.exp(-m[b] * codes[k][b])) for b in range(width)) for k in range(len(names))]
        p = [math.exp(min(loss) - x) for x in loss]
        order = sorted(range(len(names)), key=lambda k: -p[k])
        out.append((names[order[0]], p[order[0]] / sum(p), (p[order[0]] - p[order[1]]) / sum(p)))
    return out
