"""Brute force that several test modules hold results against."""

from __future__ import annotations

import base64

import public_tokenizers
import tiktoken
import xxhash


def reference():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        out.append(t[:len(t) - half] + texts[(i + 1) % len(texts)][:half])
    return out


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    """Smallest index reachable."""
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(nodes))]
