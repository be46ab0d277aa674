from .digest import md5_bucket
from .numeric import clamped_sigmoid, dot, label_loss
from .vectors import dense_array, dense_vector, sparse_vector, stored_vector, vector_entries, vector_sparsity
from .words import clean_word, is_kept, lines_to_words

__all__ = [
    "clamped_sigmoid",
    "clean_word",
    "dense_array",
    "dense_vector",
    "dot",
    "is_kept",
    "label_loss",
    "lines_to_words",
    "md5_bucket",
    "sparse_vector",
    "stored_vector",
    "vector_entries",
    "vector_sparsity",
]
