"""quire: document analytics (OCR block graphs, personal data, entities, classification, retrieval, review) as
Spark DataFrame operators."""

import sys as _sys

try:  # Functions shipped to Python workers (pandas UDFs, streaming state) carry their code with them, so
    # executors need no installed copy of this package.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
