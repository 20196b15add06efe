from lexiloom.providers.base import CallSettings, Provider, RetryPolicy, Step, TruncatedOutput
from lexiloom.providers.calls import call_chain, call_model, call_round_trip, passes, try_attempt, try_attempts

__all__ = [
    "CallSettings",
    "Provider",
    "RetryPolicy",
    "Step",
    "TruncatedOutput",
    "call_chain",
    "call_model",
    "call_round_trip",
    "passes",
    "try_attempt",
    "try_attempts",
]
