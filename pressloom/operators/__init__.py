"""Table operators: links, crawl cuts, robots, releases, spelling, numbering."""
