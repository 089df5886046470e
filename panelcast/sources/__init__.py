"""Reading panels, generating them, and writing result tables."""
