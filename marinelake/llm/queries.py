"""All queries of the training-data operators."""

from marinelake.llm import centroids, language, licences, minhash, multi_index, neighbours, packing, passages, pieces, prefixes, surrogates, urls, wavelet
from marinelake.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "centroids", "language", "licences", "minhash", "multi_index", "neighbours", "packing", "passages", "pieces", "prefixes", "surrogates", "urls", "wavelet"]
