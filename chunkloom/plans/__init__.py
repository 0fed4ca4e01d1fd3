"""The jobs and listing queries users call."""
