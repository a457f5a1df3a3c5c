from .program import main

main()
