"""End-to-end jobs: layers, forecast run, subset, re-encoding."""
