"""hivewire: building-telemetry dataflows (registration, decode, latest value,
query/command routing and gathering) expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
