from emberlog.plans.batch import main

main()
