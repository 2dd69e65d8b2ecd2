from .exprs import blank_to_null, duration_ms, event_type, parsed_payload, payload_value, round2
from .quantiles import exact_quantiles

__all__ = ["blank_to_null", "duration_ms", "event_type", "exact_quantiles", "parsed_payload", "payload_value", "round2"]
