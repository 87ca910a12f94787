"""Table readers, adapters and parameter decoding."""
