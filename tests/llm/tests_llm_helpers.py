"""Plain-Python emulation of the pipeline's decisions."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from headway.llm import quality, secrets, toxicity
from headway.llm.common import read_table
from test_llm_operators import brute_components, plain_counts


def keeps(text: str) -> bool:
    n, chars, symbols, dup, repeated = plain_counts(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    longest = max(map(len, re.findall(r"[^\x20\x09-\x0D]+", text)), default=0)
    return not (n < 50 or 100 * repeated > 50 * n or 100 * symbols > quality.MAX_SYMBOLS * n
                or 100 * dup > quality.MAX_DUP_LINES * len(lines) or chars < quality.MEAN_WORD[0] * n
                or chars > quality.MEAN_WORD[1] * n or longest > quality.MAX_WORD)


def secret_spans(text: str):
    out = []
    for kind, pattern, group, least in (("assign", secrets.ASSIGN, 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20),
                                        ("hex", "[0-9a-f]+", 0, 24)):
        out += [(m.start(), m.end(), m[group]) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    base = list(out)
    for m in re.finditer("[A-Za-z0-9_-]{32,}", text):
        if all(re.search(p, m[0]) for p in ("[a-z]", "[A-Z]", "[0-9]")) and not any(s < m.end() and m.start() < e for s, e, _ in base):
            out.append((m.start(), m.end(), m[0]))
    return sorted(out)


def redacted(rows):
    owners, texts = collections.defaultdict(set), collections.defaultdict(set)
    for _, text, source in rows:
        for *_, value in secret_spans(text):
            owners[value].add(source)
            texts[value].add(text)
    for i, text, source in rows:
        out, at = "", 0
        for s, e, value in secret_spans(text):
            if min(len(owners[value]), len(texts[value])) < secrets.WIDESPREAD:
                if s >= at:
                    out += text[at:s] + secrets.MARK
                at = max(at, e)
        yield i, out + text[at:], source


def brute_pipeline(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    rows = [r for r in rows if keeps(r[1])]
    kept = docs.where(docs.doc_id.isin([r[0] for r in rows]))
    # the trained field itself is held against all paths elsewhere
    toxic = {r.doc_id for r in toxicity.score(kept, read_table(spark, sf_dir, "labels")).collect() if r.predicted}
    rows = [r for r in rows if r[0] not in toxic]
    root, _ = brute_components([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if root[r[0]] == r[0]]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = collections.Counter()
    for i, text, _ in redacted(rows):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            out[i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out
