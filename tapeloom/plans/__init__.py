"""Relations and SQL texts that state what the registered queries compute."""
