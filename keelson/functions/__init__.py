from keelson.functions.casts import (lenient_date, lenient_date_any, lenient_double, lenient_int,
                                     lenient_long)
from keelson.functions.batch import batch_key_of, business_date, BATCH_TOKEN_RE

__all__ = ["lenient_date", "lenient_date_any", "lenient_double", "lenient_int", "lenient_long",
           "batch_key_of", "business_date", "BATCH_TOKEN_RE"]
