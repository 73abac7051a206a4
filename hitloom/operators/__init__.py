from hitloom.operators.compact import required_key_check, to_compact
from hitloom.operators.explode import explode_sessions
from hitloom.operators.flatten import flatten
from hitloom.operators.upsert import UpsertResult, stage, upsert, write_clustered

__all__ = ["UpsertResult", "explode_sessions", "flatten", "required_key_check", "stage",
           "to_compact", "upsert", "write_clustered"]
