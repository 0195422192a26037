"""A tiny ONNX sequence classifier and tokenizer, written for tests.

The model sums a per-token logit table over the unmasked tokens:
logits[b] = sum_t mask[b,t] * table[input_ids[b,t]]. The file is encoded
directly in the protobuf wire format (the onnx package is not installed).
"""

from __future__ import annotations

import struct

import numpy as np

FLOAT, INT64 = 1, 7


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        out.append(b | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _key(field: int, wire: int) -> bytes:
    return _varint((field << 3) | wire)


def _int(field: int, v: int) -> bytes:
    return _key(field, 0) + _varint(v)


def _bytes(field: int, v: bytes) -> bytes:
    return _key(field, 2) + _varint(len(v)) + v


def _str(field: int, v: str) -> bytes:
    return _bytes(field, v.encode())


def tensor(name: str, array: np.ndarray, dtype: int) -> bytes:
    body = b"".join(_int(1, d) for d in array.shape) + _int(2, dtype) + _str(8, name)
    raw = array.astype("<f4" if dtype == FLOAT else "<i8").tobytes()
    return body + _bytes(9, raw)


def value_info(name: str, dtype: int, dims: list) -> bytes:
    shape = b"".join(_bytes(1, _str(2, d) if isinstance(d, str) else _int(1, d)) for d in dims)
    tensor_type = _int(1, dtype) + _bytes(2, shape)
    return _str(1, name) + _bytes(2, _bytes(1, tensor_type))


def node(op: str, inputs: list[str], outputs: list[str], attrs: bytes = b"") -> bytes:
    return b"".join(_str(1, i) for i in inputs) + b"".join(_str(2, o) for o in outputs) + _str(4, op) + attrs


def attr_int(name: str, v: int) -> bytes:
    return _bytes(5, _str(1, name) + _int(20, 2) + _int(3, v))


def build_model(table: np.ndarray) -> bytes:
    nodes = [
        node("Gather", ["table", "input_ids"], ["emb"]),
        node("Cast", ["attention_mask"], ["maskf"], attr_int("to", FLOAT)),
        node("Unsqueeze", ["maskf", "axis2"], ["mask3"]),
        node("Mul", ["emb", "mask3"], ["masked"]),
        node("ReduceSum", ["masked", "axis1"], ["logits"], attr_int("keepdims", 0)),
    ]
    graph = (
        b"".join(_bytes(1, n) for n in nodes)
        + _str(2, "tiny")
        + _bytes(5, tensor("table", table.astype(np.float32), FLOAT))
        + _bytes(5, tensor("axis2", np.array([2]), INT64))
        + _bytes(5, tensor("axis1", np.array([1]), INT64))
        + _bytes(11, value_info("input_ids", INT64, ["batch", "seq"]))
        + _bytes(11, value_info("attention_mask", INT64, ["batch", "seq"]))
        + _bytes(12, value_info("logits", FLOAT, ["batch", table.shape[1]]))
    )
    opset = _str(1, "") + _int(2, 13)
    return _int(1, 8) + _bytes(8, opset) + _bytes(7, graph)


def build_tokenizer(vocab: dict[str, int]):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    tok = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
    tok.normalizer = normalizers.Lowercase()
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    return tok


def write(dirpath: str, vocab: dict[str, int], table: np.ndarray) -> tuple[str, str]:
    model_path, tok_path = f"{dirpath}/tiny.onnx", f"{dirpath}/tokenizer.json"
    with open(model_path, "wb") as f:
        f.write(build_model(table))
    build_tokenizer(vocab).save(tok_path)
    return model_path, tok_path


def reference_scores(texts, vocab, table, labels, max_length):
    """Brute force: the same windows and averaging in plain NumPy."""
    tok = build_tokenizer(vocab)
    out_l, out_s = [], []
    for t in texts:
        ids = tok.encode(t or "").ids or [vocab["[PAD]"]]
        windows = [ids[s:s + max_length] for s in range(0, len(ids), max_length)]
        mean = np.mean([table[w].sum(axis=0) for w in windows], axis=0)
        p = np.exp(mean - mean.max())
        p /= p.sum()
        k = int(p.argmax())
        out_l.append(labels[k])
        out_s.append(float(p[k]))
    return out_l, out_s


__all__ = ["write", "reference_scores", "struct"]
