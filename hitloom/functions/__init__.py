from hitloom.functions.metrics import as_of_date, date_cutoff, ratio, session_key
from hitloom.functions.variant import content_hash, vget, vpresent, vtext

__all__ = ["as_of_date", "content_hash", "date_cutoff", "ratio", "session_key",
           "vget", "vpresent", "vtext"]
