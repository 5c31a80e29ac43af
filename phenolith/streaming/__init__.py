"""The stateless steps on a streaming frame."""
