"""The warehouse models: staging, integration and mart plans."""
