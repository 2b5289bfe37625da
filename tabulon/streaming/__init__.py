"""Page-local operators over streams of pages."""
