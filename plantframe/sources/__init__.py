"""Sources and sinks (S1–S10): meter and forecast CSV, parameters, JSON payloads, HTML prices, sinks."""
